"""Tables, their keys and the values their state columns may take."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _table(strings: str, at: bool = True, **others: T.DataType) -> T.StructType:
    fields = [T.StructField(n, others.pop(n, T.StringType())) for n in strings.split()]
    fields += [T.StructField(n, t) for n, t in others.items()]
    return T.StructType(fields + ([T.StructField("created_at", T.TimestampType())] if at else []))


BATCHES = "creating_batch_id ner_batch_id ned1_batch_id ned2_batch_id nedg_batch_id pd_batch_id pdg_batch_id"
TABLES = {
    "batch_job": _table("id input_file_id status output_file_id job_type"),
    "entity": _table("id status description label embedding_index first_appeared explored_batch_id", embedding_index=T.LongType()),
    "predicate": _table("id label embedding_index description first_appeared", False, embedding_index=T.LongType()),
    "concept": _table("id label embedding_index description first_appeared", False, embedding_index=T.LongType()),
    "triple": _table(
        f"triple_id subject_id subject_label predicate_label predicate_id predicate_status object_label object_id object_type object_status object_description {BATCHES}"
    ),
    "instance_triple": T.StructType([*_table("original_triple_id entity_id concept_label concept_id cd_batch_id cdg_batch_id").fields, T.StructField("status", T.StringType())]),
    "ned1_link": _table("triple_id instance_node_id", False, position=T.IntegerType()),
    "ned2_link": _table("triple_id instance_node_id", False, position=T.IntegerType()),
    "pd_link": _table("triple_id predicate_id", False, position=T.IntegerType()),
    "cd_link": _table("original_triple_id concept_id", False, position=T.IntegerType()),
    "vector": _table("kind embedding_index embedding", False, embedding_index=T.LongType(), embedding=T.ArrayType(T.FloatType())),
}
KEYS = {
    "batch_job": ["id"], "entity": ["id"], "predicate": ["id"], "concept": ["id"], "triple": ["triple_id"], "instance_triple": ["original_triple_id"],
    "ned1_link": ["triple_id", "instance_node_id"], "ned2_link": ["triple_id", "instance_node_id"], "pd_link": ["triple_id", "predicate_id"],
    "cd_link": ["original_triple_id", "concept_id"], "vector": ["kind", "embedding_index"],
}
ENTITY_STATUS = ("unexplored", "exploring", "explored")
OBJECT_STATUS = ("generated", "onner", "ner_finished", "onned1", "ned_finished1", "ondg", "dg_finished", "onned2", "finished")
PREDICATE_STATUS = ("generated", "onpd", "pd_finished", "ondg", "finished")
CONCEPT_STATUS = ("generated", "oncd", "cd_finished", "ondg", "finished")
OBJECT_TYPE = ("literal", "ne", "class", "unrecognized")
#: The answer "unsure" of the first disambiguation, in place of an entity id.
UNSURE = "unclear NED1"
#: Job type of each stage, the batch column of its items, and the group whose gate it closes.
JOBS = {
    "elicitation": ("elicitation", "explored_batch_id", None), "ner": ("ner", "ner_batch_id", None), "ned1": ("ned_source_triple", "ned1_batch_id", "NED"),
    "nedg": ("nedg", "nedg_batch_id", "NED"), "ned2": ("ned_description", "ned2_batch_id", "NED"), "pd": ("pd", "pd_batch_id", "PD"), "pdg": ("pdg", "pdg_batch_id", "PD"),
    "cd": ("cd", "cd_batch_id", "CD"), "cdg": ("cdg", "cdg_batch_id", "CD"),
}
IN_PROCESS = ("created", "validating", "in_progress", "finalizing", "cancelling", "parsing")
SIGNATURE = ["subject_id", "subject_label", "predicate_id", "predicate_label", "object_id", "object_label"]


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: rows delivered again are dropped."""
    return df.dropDuplicates(list(keys))


def outside_domain(df: DataFrame, column: str, domain: tuple[str, ...]) -> DataFrame:
    """Rows whose ``column`` is not one of ``domain``; null is outside."""
    return df.filter(~F.coalesce(F.col(column).isin(*domain), F.lit(False)))
