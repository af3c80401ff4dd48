"""The queries over the knowledge base, and DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import capacity, ids, parsing, prompts
from factloom.operators import candidates, dedup, delta, outcomes, queues, reuse, upsert, vectors
from factloom.operators.ingest import ingest
from factloom.plans import skew
from factloom.runtime import staged, table
from factloom.schema import CONCEPT_STATUS, ENTITY_STATUS, JOBS, OBJECT_STATUS, OBJECT_TYPE, PREDICATE_STATUS, SIGNATURE, once, outside_domain
from factloom.sources import jsonl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(skew.QUERIES)
ORACLE: dict[str, str] = dict(skew.ORACLE)

KEY = {"triple": "triple_id", "instance_triple": "original_triple_id", "entity": "id", "predicate": "id", "concept": "id", "batch_job": "id"}
#: Whole tables without rows delivered again, for the SQL of all queries.
WITH = "WITH " + ", ".join(f"{t[0] if t != 'predicate' else 'p'}_ AS (SELECT DISTINCT * FROM {t})" for t in ("triple", "instance_triple", "entity", "predicate", "concept", "batch_job"))
NUM = "TRY_CAST(substr({0}, 2) AS BIGINT)"
TRIM = "regexp_replace({0}, '^[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+|[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ]+$', '', 'g')"


def at(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with each row once."""
    return once(table(spark, root, name), KEY[name])


def state_of(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: at(spark, root, name) for name in KEY}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = f"{WITH} {sql}"
        return f

    return add


def n(ident: str) -> str:
    return NUM.format(ident)


# --- reuse: A1-A6, W7, W8 -----------------------------------------------------------------------------------------

_CONSISTENT = "SELECT predicate_label, object_label, min(object_id) AS object_id, count(*) AS facts FROM t_ WHERE object_type = 'ne' AND object_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > {0} AND min(object_id) = max(object_id)"


@query("consistent_object_map", _CONSISTENT.format(50))
def consistent_object_map(spark: SparkSession, root: str) -> DataFrame:
    return reuse.consistent_objects(at(spark, root, "triple"))


@query("consistent_object_map_low", _CONSISTENT.format(1))
def consistent_object_map_low(spark: SparkSession, root: str) -> DataFrame:
    return reuse.consistent_objects(at(spark, root, "triple"), 1)


for _name, _condition in (("batch", "ned1_batch_id IS NOT NULL"), ("single", "object_type = 'ne' AND object_id IS NOT NULL")):

    @query(f"ned_frequency_{_name}", f"SELECT object_label, count(*) AS n FROM t_ WHERE {_condition} AND object_label IS NOT NULL GROUP BY 1")
    def _(spark: SparkSession, root: str, batchwise: bool = _name == "batch") -> DataFrame:
        return reuse.ned_frequency(at(spark, root, "triple"), batchwise)


@query("predicate_label_map", "SELECT predicate_label, max(predicate_id) AS predicate_id FROM t_ WHERE predicate_id IS NOT NULL AND length(predicate_label) > 1 GROUP BY 1")
def predicate_label_map(spark: SparkSession, root: str) -> DataFrame:
    return reuse.label_map(at(spark, root, "triple"), "predicate_label", "predicate_id", 1)


@query("concept_label_map", "SELECT concept_label, max(concept_id) AS concept_id FROM i_ WHERE concept_id IS NOT NULL AND concept_label IS NOT NULL GROUP BY 1")
def concept_label_map(spark: SparkSession, root: str) -> DataFrame:
    return reuse.label_map(at(spark, root, "instance_triple"), "concept_label", "concept_id")


for _name, _table, _label, _key, _status, _prefix in (
    ("predicates_full", "triple", "predicate_label", "triple_id", "predicate_status", None),
    ("predicates_prefix", "triple", "predicate_label", "triple_id", "predicate_status", 5),
    ("concepts_full", "instance_triple", "concept_label", "original_triple_id", "status", None),
    ("concepts_prefix", "instance_triple", "concept_label", "original_triple_id", "status", 3),
):
    _cut = _label if _prefix is None else f"substr({_label}, 1, {_prefix})"

    @query(
        f"thin_{_name}",
        f"SELECT {TRIM.format(f'lower({_cut})')} AS norm, arg_min({_key}, {n(_key)}) AS {_key} FROM {_table[0]}_ WHERE {_status} = 'generated' AND {_label} IS NOT NULL GROUP BY 1",
    )
    def _(spark: SparkSession, root: str, name=_table, label=_label, key=_key, status=_status, prefix=_prefix) -> DataFrame:
        return reuse.thin_by_label(at(spark, root, name).filter(F.col(status) == "generated"), label, key, prefix)


@query("kb_totals", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS n FROM {t}" for t, k in KEY.items()))
def kb_totals(spark: SparkSession, root: str) -> DataFrame:
    return reuse.totals(**{t: (table(spark, root, t), k) for t, k in KEY.items()})


@query("max_triple_counter", f"SELECT max({n('triple_id')}) + 1 AS next_number FROM triple")
def max_triple_counter(spark: SparkSession, root: str) -> DataFrame:
    return ids.next_number(table(spark, root, "triple"), "triple_id")


@query("capacity_plan", "SELECT 'entity' AS table_name, CAST(ceil(count(DISTINCT id) * 1.5) AS BIGINT) AS expected FROM entity UNION ALL SELECT 'triple', CAST(ceil(count(DISTINCT id) * 38450135 / 2297995) AS BIGINT) FROM entity")
def capacity_plan(spark: SparkSession, root: str) -> DataFrame:
    entities = F.count_distinct("id").alias("e")
    plan = F.array(
        F.struct(F.lit("entity").alias("table_name"), F.ceil(F.col("e") * F.lit(capacity.HEADROOM)).alias("expected")),
        F.struct(F.lit("triple").alias("table_name"), F.ceil(F.col("e") * F.lit(capacity.TRIPLES) / F.lit(capacity.ENTITIES)).alias("expected")),
    )
    return table(spark, root, "entity").agg(entities).select(F.explode(plan).alias("x")).select("x.*")


_DOMAINS = (("triple", "object_status", OBJECT_STATUS), ("triple", "predicate_status", PREDICATE_STATUS), ("triple", "object_type", OBJECT_TYPE), ("instance_triple", "status", CONCEPT_STATUS), ("entity", "status", ENTITY_STATUS))


@query("outside_domains", " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n FROM {t[0]}_ WHERE {c} IS NULL OR {c} NOT IN {d}" for t, c, d in _DOMAINS))
def outside_domains(spark: SparkSession, root: str) -> DataFrame:
    """Rows with a state that no table may hold."""
    whole = None
    for name, column, domain in _DOMAINS:
        one = outside_domain(at(spark, root, name), column, domain).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "n")
        whole = one if whole is None else whole.unionByName(one)
    return whole


# --- queues: F1-F13 ----------------------------------------------------------------------------------------------

_READY_SQL = {
    "elicitation": "status = 'unexplored'", "ner": "object_type = 'unrecognized' AND object_status = 'generated' AND predicate_status IN ('pd_finished', 'ondg', 'finished')",
    "ned1": "object_type = 'ne' AND object_status = 'ner_finished'", "ned2": "object_type = 'ne' AND object_status = 'dg_finished' AND object_description IS NOT NULL",
    "nedg": "object_type = 'ne' AND object_status = 'ned_finished1'", "pd": "predicate_status = 'generated'", "pdg": "predicate_status = 'pd_finished'",
    "cd": "status = 'generated'", "cdg": "status = 'cd_finished'",
}
for _stage, _condition in _READY_SQL.items():
    _table, _key = queues.READY[_stage]

    @query(f"ready_{_stage}", f"SELECT {_key} FROM {_table[0]}_ WHERE {_condition}")
    def _(spark: SparkSession, root: str, stage=_stage, name=_table, key=_key) -> DataFrame:
        return queues.ready(table(spark, root, name), stage).select(key)


@query("ready_ned1_first", f"SELECT triple_id FROM t_ WHERE {_READY_SQL['ned1']} ORDER BY {n('triple_id')} LIMIT 500")
def ready_ned1_first(spark: SparkSession, root: str) -> DataFrame:
    return queues.ready(table(spark, root, "triple"), "ned1", 500).select("triple_id")


@query("chunk_work_queue", f"SELECT triple_id, CAST(floor((row_number() OVER (ORDER BY {n('triple_id')}) - 1) / 400) AS BIGINT) AS batch_no FROM t_ WHERE {_READY_SQL['pd']}")
def chunk_work_queue(spark: SparkSession, root: str) -> DataFrame:
    return queues.chunked(queues.ready(table(spark, root, "triple"), "pd"), "triple_id", 400).select("triple_id", "batch_no")


@query("in_process_batches", "SELECT id FROM b_ WHERE status IN ('created', 'validating', 'in_progress', 'finalizing', 'cancelling', 'parsing')")
def in_process_batches(spark: SparkSession, root: str) -> DataFrame:
    return queues.in_process(table(spark, root, "batch_job")).select("id")


_HELD = " UNION ALL ".join(
    f"SELECT id, job_type FROM b_ WHERE status = 'cancelled' AND job_type = '{job}' AND id IN (SELECT {column} FROM {queues.READY[stage][0]} WHERE {column} IS NOT NULL)" for stage, (job, column, _) in JOBS.items()
)


@query("cancelled_batches", _HELD)
def cancelled_batches(spark: SparkSession, root: str) -> DataFrame:
    state = {name: table(spark, root, name) for name in ("triple", "instance_triple", "entity")}
    return queues.holding_items(table(spark, root, "batch_job"), state)


_GROUP = "CASE " + " ".join(f"WHEN job_type = '{job}' THEN '{group}'" for job, _, group in JOBS.values() if group) + " END"


@query("batch_gates", f"SELECT gate, NOT EXISTS (SELECT 1 FROM b_ WHERE {_GROUP} = gate AND status IN ('created', 'validating', 'in_progress', 'finalizing', 'cancelling', 'parsing')) AS open FROM (VALUES ('NED'), ('PD'), ('CD')) AS g(gate)")
def batch_gates(spark: SparkSession, root: str) -> DataFrame:
    return queues.gates(table(spark, root, "batch_job"))


@query("batch_counts", "SELECT job_type, status, count(*) AS n FROM b_ GROUP BY 1, 2")
def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    return queues.batch_counts(table(spark, root, "batch_job"))


# --- collisions: W1-W6, J2, J3 -----------------------------------------------------------------------------------

_SIG = ", ".join(SIGNATURE)


def _picks(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Facts that wait for an object, each picking the entity whose number is that of its subject."""
    facts = at(spark, root, "triple")
    picks = facts.filter("object_type = 'ne' and object_id is null").withColumn("object_id", F.col("subject_id"))
    return picks, facts


_PICKS = "SELECT * REPLACE (subject_id AS object_id) FROM t_ WHERE object_type = 'ne' AND object_id IS NULL"
for _name, _safe, _match, _order in (("nullsafe", True, "IS NOT DISTINCT FROM", "triple_id"), ("strict", False, "=", n("triple_id"))):
    _on = " AND ".join(f"s.{c} {_match if c == 'predicate_id' else '='} p.{c}" for c in SIGNATURE)

    @query(
        f"signature_dedup_{_name}",
        f"SELECT triple_id, (nth > 1 OR EXISTS (SELECT 1 FROM t_ s WHERE {_on})) AS is_duplicate FROM (SELECT *, row_number() OVER (PARTITION BY {_SIG} ORDER BY {_order}) AS nth FROM ({_PICKS})) p",
    )
    def _(spark: SparkSession, root: str, safe=_safe) -> DataFrame:
        picks, facts = _picks(spark, root)
        return dedup.resolve_picks(picks, facts, safe, not safe).select("triple_id", "is_duplicate")


_PMAP = "SELECT predicate_label, max(predicate_id) AS pid FROM t_ WHERE predicate_id IS NOT NULL AND length(predicate_label) > 1 GROUP BY 1"


@query(
    "pd_cache_apply",
    f"""SELECT triple_id, pid AS predicate_id, (nth > 1 OR EXISTS (SELECT 1 FROM t_ s WHERE s.subject_id = q.subject_id AND s.predicate_id = q.pid AND s.object_label = q.object_label)) AS is_duplicate
    FROM (SELECT t_.*, pid, row_number() OVER (PARTITION BY subject_id, pid, object_label ORDER BY {n("triple_id")}) AS nth FROM t_ JOIN ({_PMAP}) USING (predicate_label) WHERE predicate_status = 'generated') q""",
)
def pd_cache_apply(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    return dedup.apply_predicate_map(queues.ready(facts, "pd"), facts, reuse.label_map(facts, "predicate_label", "predicate_id", 1))


_CMAP = "SELECT concept_label, max(concept_id) AS cid FROM i_ WHERE concept_id IS NOT NULL AND concept_label IS NOT NULL GROUP BY 1"


@query(
    "cd_cache_apply",
    f"""SELECT original_triple_id, cid AS concept_id, (nth > 1 OR EXISTS (SELECT 1 FROM i_ s WHERE s.entity_id = q.entity_id AND s.concept_id = q.cid)) AS is_duplicate
    FROM (SELECT i_.*, cid, row_number() OVER (PARTITION BY entity_id, cid ORDER BY {n("original_triple_id")}) AS nth FROM i_ JOIN ({_CMAP}) USING (concept_label) WHERE status = 'generated') q""",
)
def cd_cache_apply(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "instance_triple")
    return dedup.apply_concept_map(queues.ready(facts, "cd"), facts, reuse.label_map(facts, "concept_label", "concept_id"))


@query("known_signatures", f"SELECT DISTINCT {_SIG} FROM t_ a WHERE object_status = 'finished' AND EXISTS (SELECT 1 FROM t_ b WHERE b.object_status <> 'finished' AND " + " AND ".join(f"a.{c} = b.{c}" for c in SIGNATURE) + ")")
def known_signatures(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    done, other = facts.filter("object_status = 'finished'").select(*SIGNATURE), facts.filter("object_status <> 'finished'").select(*SIGNATURE)
    return done.join(other, SIGNATURE, "left_semi").distinct()


@query("insert_or_ignore", f"SELECT triple_id FROM t_ WHERE object_type = 'class' AND NOT EXISTS (SELECT 1 FROM i_ WHERE original_triple_id = triple_id)")
def insert_or_ignore(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple").filter("object_type = 'class'").select(F.col("triple_id").alias("original_triple_id"))
    return dedup.insert_or_ignore(facts, at(spark, root, "instance_triple"), ["original_triple_id"]).select(F.col("original_triple_id").alias("triple_id"))


# --- upserts and ingest: M1, M12-M14, W10, W12 -------------------------------------------------------------------


def _upsert_sql(items: str, item: str, label: str, description: str, known: str, prefix: str) -> str:
    return f"""SELECT x.{item}, coalesce(k.id, '{prefix}' || CAST(start + nth AS VARCHAR)) AS id
    FROM (SELECT {item}, {label} AS label, {description} AS description FROM {items}) x
    LEFT JOIN (SELECT label, description, min(id) AS id FROM {known} GROUP BY 1, 2) k USING (label, description)
    LEFT JOIN (SELECT label, description, row_number() OVER (ORDER BY first) - 1 AS nth FROM (SELECT {label} AS label, {description} AS description, min({n(item)}) AS first FROM {items} i
               WHERE NOT EXISTS (SELECT 1 FROM {known} k WHERE k.label = i.{label} AND k.description = i.{description}) GROUP BY 1, 2)) f USING (label, description)
    CROSS JOIN (SELECT max({n("id")}) + 1 AS start FROM {known})"""


_NED2 = f"(SELECT * FROM t_ WHERE {_READY_SQL['ned2']})"


@query("upsert_entities", _upsert_sql(_NED2, "triple_id", "object_label", "object_description", "e_", "E"))
def upsert_entities(spark: SparkSession, root: str) -> DataFrame:
    items = queues.ready(table(spark, root, "triple"), "ned2").select("triple_id", F.col("object_label").alias("label"), F.col("object_description").alias("description"))
    return upsert.upsert_pairs(items, at(spark, root, "entity"), "E")[0]


@query("upsert_predicates", _upsert_sql("(SELECT *, 'Relation ' || predicate_label AS about FROM t_ WHERE predicate_status = 'pd_finished')", "triple_id", "predicate_label", "about", "p_", "P"))
def upsert_predicates(spark: SparkSession, root: str) -> DataFrame:
    items = queues.ready(table(spark, root, "triple"), "pdg").select("triple_id", F.col("predicate_label").alias("label"), F.concat(F.lit("Relation "), "predicate_label").alias("description"))
    return upsert.upsert_pairs(items, at(spark, root, "predicate"), "P")[0]


@query("upsert_concepts", _upsert_sql("(SELECT *, 'Class ' || concept_label AS about FROM i_ WHERE status = 'cd_finished')", "original_triple_id", "concept_label", "about", "c_", "C"))
def upsert_concepts(spark: SparkSession, root: str) -> DataFrame:
    items = queues.ready(table(spark, root, "instance_triple"), "cdg").select("original_triple_id", F.col("concept_label").alias("label"), F.concat(F.lit("Class "), "concept_label").alias("description"))
    return upsert.upsert_pairs(items, at(spark, root, "concept"), "C", "original_triple_id")[0]


_INGEST = f"""SELECT 'T' || CAST((SELECT max({n("triple_id")}) + 1 FROM t_) + row_number() OVER (ORDER BY {n("r.triple_id")}) - 1 AS VARCHAR) AS triple_id, r.subject_id, r.object_label, k.object_id,
    CASE WHEN k.object_id IS NULL AND r.predicate_label = 'instanceOf' THEN 'P0' END AS predicate_id,
    CASE WHEN k.object_id IS NOT NULL THEN 'ne' WHEN r.predicate_label = 'instanceOf' THEN 'class' ELSE 'unrecognized' END AS object_type,
    CASE WHEN k.object_id IS NOT NULL OR r.predicate_label = 'instanceOf' THEN 'finished' ELSE 'generated' END AS object_status
    FROM t_ r LEFT JOIN ({_CONSISTENT.format(1)}) k USING (predicate_label, object_label)"""


def _ingested(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    facts = at(spark, root, "triple")
    raw = facts.select("subject_id", F.col("subject_label").alias("subject"), F.col("predicate_label").alias("predicate"), F.col("object_label").alias("object"), F.col("triple_id").alias("__source"))
    start = ids.next_number(facts, "triple_id").first()[0]
    return ingest(raw, reuse.consistent_objects(facts, 1), start, ids.num(F.col("__source")))


@query("ingest_with_reuse", _INGEST)
def ingest_with_reuse(spark: SparkSession, root: str) -> DataFrame:
    return _ingested(spark, root)[0].select("triple_id", "subject_id", "object_label", "object_id", "predicate_id", "object_type", "object_status")


@query("ingest_instance_of", f"SELECT triple_id AS original_triple_id, subject_id AS entity_id, object_label AS concept_label FROM ({_INGEST}) WHERE object_type = 'class'")
def ingest_instance_of(spark: SparkSession, root: str) -> DataFrame:
    return _ingested(spark, root)[1].select("original_triple_id", "entity_id", "concept_label")


# --- candidates: J5, J6, J9, J10, A9, A10, U1, V1-V5, F14 ----------------------------------------------------------


@query("group_size_split", "SELECT label, count(DISTINCT id) AS n, count(DISTINCT id) > 5 AS many FROM e_ WHERE description IS NOT NULL AND label IS NOT NULL GROUP BY 1")
def group_size_split(spark: SparkSession, root: str) -> DataFrame:
    return candidates.group_split(at(spark, root, "entity"))


@query("exact_label_groups", f"SELECT triple_id, id AS candidate FROM {_NED2} x JOIN e_ ON label = object_label WHERE description IS NOT NULL")
def exact_label_groups(spark: SparkSession, root: str) -> DataFrame:
    return candidates.exact_matches(queues.ready(table(spark, root, "triple"), "ned2"), "triple_id", "object_label", at(spark, root, "entity")).select("triple_id", "candidate")


_VECTORS = "(SELECT kind, embedding_index AS idx, min(embedding) AS v FROM label_vector WHERE embedding IS NOT NULL GROUP BY 1, 2)"
_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda x: x[1]::DOUBLE * x[2]::DOUBLE))"
_UNITS = f"(SELECT kind, idx, v, sqrt({_DOT.format('v', 'v')}) AS norm FROM {_VECTORS})"
_TOPK = f"""SELECT kind, query, neighbour, CAST(nth - 1 AS INTEGER) AS position FROM (
    SELECT q.kind, q.idx AS query, b.idx AS neighbour, row_number() OVER (PARTITION BY q.kind, q.idx ORDER BY round({_DOT.format("q.v", "b.v")} / (q.norm * b.norm), 9) DESC, b.idx) AS nth
    FROM {_UNITS} q JOIN {_UNITS} b ON q.kind = b.kind AND q.idx <> b.idx WHERE q.norm > 0 AND b.norm > 0 AND q.idx % 100 = 0) WHERE nth <= 5"""


def _topk(spark: SparkSession, root: str) -> DataFrame:
    base = table(spark, root, "label_vector").select("kind", F.col("embedding_index").alias("idx"), "embedding")
    return vectors.exact_topk(base.filter(F.col("idx") % 100 == 0), base)


@query("topk_neighbors", _TOPK)
def topk_neighbors(spark: SparkSession, root: str) -> DataFrame:
    return _topk(spark, root).select("kind", "query", "neighbour", "position")


def _links(spark: SparkSession, root: str) -> DataFrame:
    """The nearest entities of every hundredth entity as links of the fact of that number."""
    near = _topk(spark, root).filter("kind = 'entity'")
    return near.select(F.concat(F.lit("T"), F.col("query").cast("string")).alias("triple_id"), F.concat(F.lit("E"), F.col("neighbour").cast("string")).alias("candidate"), "position")


_LINKS = f"(SELECT 'T' || CAST(query AS VARCHAR) AS triple_id, 'E' || CAST(neighbour AS VARCHAR) AS candidate, position FROM ({_TOPK}) WHERE kind = 'entity')"


@query("candidate_pick", f"SELECT triple_id, CASE WHEN choice <= count(*) THEN arg_max(candidate, rank) FILTER (rank = choice) END AS picked FROM (SELECT *, row_number() OVER (PARTITION BY triple_id ORDER BY position) AS rank, ({n('triple_id')} // 100) % 7 + 1 AS choice FROM {_LINKS} l JOIN e_ ON id = candidate) GROUP BY triple_id, choice")
def candidate_pick(spark: SparkSession, root: str) -> DataFrame:
    found = candidates.ordered(_links(spark, root), "triple_id", "candidate", at(spark, root, "entity"))
    choice = (F.floor(ids.num(F.col("triple_id")) / 100) % 7 + 1).cast("int")
    return found.select("triple_id", candidates.pick(F.col("candidates"), choice).alias("picked"))


_SAME = f"(SELECT triple_id, id AS candidate, row_number() OVER (PARTITION BY triple_id ORDER BY {n('id')}) - 1 AS position FROM (SELECT DISTINCT 'T' || substr(a.id, 2) AS triple_id, b.id FROM e_ a JOIN e_ b ON a.label = b.label AND a.id <> b.id WHERE {n('a.id')} % 100 = 0))"


@query(
    "merge_candidates",
    f"""SELECT triple_id, candidate, CAST(nth - 1 AS INTEGER) AS position FROM (SELECT triple_id, candidate, row_number() OVER (PARTITION BY triple_id ORDER BY source, place, candidate) AS nth FROM (
    SELECT triple_id, candidate, min(source) AS source, arg_min(position, source) AS place FROM (SELECT *, 0 AS source FROM {_SAME} UNION ALL SELECT *, 1 FROM {_LINKS}) GROUP BY 1, 2)) WHERE nth <= 5""",
)
def merge_candidates(spark: SparkSession, root: str) -> DataFrame:
    from pyspark.sql import Window

    entities = at(spark, root, "entity")
    one = entities.filter(ids.num(F.col("id")) % 100 == 0).select(F.concat(F.lit("T"), F.substring("id", 2, 100)).alias("triple_id"), "label", F.col("id").alias("__own"))
    pairs = one.join(entities.select("label", F.col("id").alias("candidate")), "label").filter("candidate <> __own").select("triple_id", "candidate")
    same = pairs.withColumn("position", F.row_number().over(Window.partitionBy("triple_id").orderBy(ids.num(F.col("candidate")))) - 1)
    return candidates.merged(same, _links(spark, root), "triple_id")


@query(
    "rerank_same_label",
    f"""SELECT item, candidate, CAST(nth - 1 AS INTEGER) AS position FROM (SELECT a.id AS item, b.id AS candidate, row_number() OVER (PARTITION BY a.id ORDER BY round({_DOT.format("x.v", "y.v")} / (x.norm * y.norm), 9) DESC, b.id) AS nth
    FROM e_ a JOIN e_ b ON a.label = b.label AND a.id <> b.id JOIN {_UNITS} x ON x.kind = 'entity' AND x.idx = a.embedding_index JOIN {_UNITS} y ON y.kind = 'entity' AND y.idx = b.embedding_index WHERE x.norm > 0 AND y.norm > 0) WHERE nth <= 5""",
)
def rerank_same_label(spark: SparkSession, root: str) -> DataFrame:
    v = table(spark, root, "label_vector").filter("kind = 'entity' and embedding is not null").groupBy("embedding_index").agg(F.min("embedding").alias("v"))
    norm = F.sqrt(candidates.cosine(F.col("v"), F.col("v")))
    named = at(spark, root, "entity").select("id", "label", "embedding_index").join(v, "embedding_index").withColumn("norm", norm).filter("norm > 0")
    a, b = named.select(F.col("id").alias("item"), "label", F.col("v").alias("x"), F.col("norm").alias("xn")), named.select(F.col("id").alias("candidate"), "label", F.col("v").alias("y"), F.col("norm").alias("yn"))
    scored = a.join(b, "label").filter("item <> candidate").withColumn("score", F.round(candidates.cosine(F.col("x"), F.col("y")) / (F.col("xn") * F.col("yn")), 9))
    return candidates.reranked(scored, "item", "score")


@query("class_fact_subjects", "SELECT original_triple_id, subject_label, object_label FROM i_ JOIN t_ ON original_triple_id = triple_id")
def class_fact_subjects(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple").select(F.col("triple_id").alias("original_triple_id"), "subject_label", "object_label")
    return at(spark, root, "instance_triple").select("original_triple_id").join(facts, "original_triple_id")


@query("cluster_labels")
def cluster_labels(spark: SparkSession, root: str) -> DataFrame:
    v = table(spark, root, "label_vector").filter("kind = 'entity'").select(F.col("embedding_index").alias("idx"), "embedding")
    return vectors.cluster_vectors(v)


@query("thin_by_cluster")
def thin_by_cluster(spark: SparkSession, root: str) -> DataFrame:
    """Facts of the NED1 queue that are asked: those no consistent object answers, thinned by clusters of their object
    labels; labels are embedded offline."""
    columns = ["triple_id", "subject_id", "predicate_label", "object_label", "object_type", "object_status", "object_id"]
    facts = staged(once(table(spark, root, "triple").select(*columns), KEY["triple"]))
    known = reuse.consistent_objects(facts).select("predicate_label", "object_label")
    waiting = facts.filter(queues.ready_condition("ned1"))
    rest = staged(waiting.join(known, ["predicate_label", "object_label"], "left_anti"))
    return reuse.thin_by_cluster(rest, facts, vectors.HashEmbedder())


# --- parsers: P0-P8 ---------------------------------------------------------------------------------------------

_LETTER = f"CASE {n('triple_id')} % 5 WHEN 0 THEN ' ' || lower(chr(CAST(65 + {n('triple_id')} % 7 AS INTEGER))) || '. ' WHEN 1 THEN 'A or B' WHEN 2 THEN '' WHEN 3 THEN 'Answer: ' || chr(CAST(65 + {n('triple_id')} % 7 AS INTEGER)) ELSE 'none of them' END"


def _letter_texts(spark: SparkSession, root: str) -> DataFrame:
    number = ids.num(F.col("triple_id"))
    letter = F.char(65 + number % 7)
    text = F.when(number % 5 == 0, F.concat(F.lit(" "), F.lower(letter), F.lit(". "))).when(number % 5 == 1, "A or B").when(number % 5 == 2, "").when(number % 5 == 3, F.concat(F.lit("Answer: "), letter)).otherwise("none of them")
    return at(spark, root, "triple").select("triple_id", text.alias("text"))


for _stage, _last, _read in (("ned1", "G", parsing.ned1_option), ("ned2", "F", parsing.ned2_option), ("pd", "G", parsing.pd_option)):
    _one = f"CASE WHEN len(list_distinct(regexp_extract_all(upper(text), '\\b([A-{_last}])\\b', 1))) = 1 THEN list_distinct(regexp_extract_all(upper(text), '\\b([A-{_last}])\\b', 1))[1] END"
    _unsure = "WHEN one = 'G' THEN 'unsure'" if _stage == "ned1" else ""

    @query(f"parse_option_letter_{_stage}", f"SELECT triple_id, outcome, CASE WHEN outcome = 'pick' THEN ascii(one) - 64 END AS choice FROM (SELECT triple_id, one, CASE {_unsure} WHEN one IS NULL OR one = 'F' THEN 'none' ELSE 'pick' END AS outcome FROM (SELECT triple_id, {_one} AS one FROM (SELECT triple_id, {_LETTER} AS text FROM t_)))")
    def _(spark: SparkSession, root: str, read=_read) -> DataFrame:
        return _letter_texts(spark, root).select("triple_id", read(F.col("text")).alias("o")).select("triple_id", "o.outcome", "o.choice")


@query("parse_description", "SELECT triple_id, CASE WHEN starts_with(text, 'Description: ') THEN string_split(text, 'Description: ')[2] ELSE text END AS description FROM (SELECT triple_id, CASE WHEN object_type = 'ne' THEN 'Description: ' || object_label || 'Description: x' ELSE object_label END AS text FROM t_)")
def parse_description(spark: SparkSession, root: str) -> DataFrame:
    text = F.when(F.col("object_type") == "ne", F.concat(F.lit("Description: "), "object_label", F.lit("Description: x"))).otherwise(F.col("object_label"))
    return at(spark, root, "triple").select("triple_id", parsing.description(text).alias("description"))


@query("strip_think", f"SELECT triple_id, {TRIM.format('object_label')} AS text FROM t_")
def strip_think(spark: SparkSession, root: str) -> DataFrame:
    text = F.concat(F.lit("<think>a\nb</think>\n "), "object_label", F.lit("<think></think> "))
    return at(spark, root, "triple").select("triple_id", parsing.strip_think(text).alias("text"))


@query("parse_facts", "SELECT subject_id, subject_label AS subject, predicate_label AS predicate, object_label AS object FROM t_")
def parse_facts(spark: SparkSession, root: str) -> DataFrame:
    fact = F.struct(F.col("subject_label").alias("subject"), F.col("predicate_label").alias("predicate"), F.col("object_label").alias("object"))
    broken = F.struct(F.lit("x").alias("subject"), F.lit(None).cast("string").alias("predicate"), F.lit("y").alias("object"))
    payload = F.to_json(F.struct(F.array(fact, broken).alias("facts")))
    return parsing.facts(at(spark, root, "triple").select("subject_id", payload.alias("text")), "subject_id", "text").drop("place")


_NE_VALUES = ["true", "false", '"false"', "0", "1", '""', "null", "[]", "[1]", "{}"]
_NE_TRUE = [True, False, True, False, True, False, False, False, True, False]


@query("parse_ner", f"SELECT triple_id, CAST(CASE {n('triple_id')} % 11 " + " ".join(f"WHEN {i} THEN {str(v).upper()}" for i, v in enumerate(_NE_TRUE)) + " END AS BOOLEAN) AS is_ne FROM t_")
def parse_ner(spark: SparkSession, root: str) -> DataFrame:
    number = ids.num(F.col("triple_id"))
    value = F.try_element_at(F.array(*[F.lit(v) for v in _NE_VALUES]), (number % 11 + 1).cast("int"))
    payload = F.when(value.isNotNull(), F.concat(F.lit('{"phrase": "x", "is_ne": '), value, F.lit("}"))).otherwise('{"phrase": "x"}')
    return at(spark, root, "triple").select("triple_id", parsing.ner(payload)["is_ne"].alias("is_ne"))


@query("parse_responses", "SELECT triple_id AS custom_id, object_label AS text FROM t_")
def parse_responses(spark: SparkSession, root: str) -> DataFrame:
    """Answers wrapped as response lines, a reasoning item before the message, and read again."""
    content = F.array(F.struct(F.lit("output_text").alias("type"), F.col("object_label").alias("text")))
    none = F.array(F.struct(F.lit("summary").alias("type"), F.lit("x").alias("text")))
    output = F.array(F.struct(F.lit("reasoning").alias("type"), none.alias("content")), F.struct(F.lit("message").alias("type"), none.alias("content")), F.struct(F.lit("message").alias("type"), content.alias("content")))
    line = F.to_json(F.struct(F.col("triple_id").alias("custom_id"), F.struct(F.struct(output.alias("output")).alias("body")).alias("response")))
    lines = at(spark, root, "triple").select(line.alias("value"))
    return lines.select(parsing.custom_id(F.col("value"), "UNKNOWN").alias("custom_id"), parsing.response_text(F.col("value")).alias("text"))


# --- prompts: Q1-Q10 --------------------------------------------------------------------------------------------

_S = "coalesce({0}, '')".format
_STATEMENT = f"'[' || {_S('subject_label')} || ', ' || {_S('predicate_label')} || ', ' || {_S('object_label')} || ']'"
_ONE = "'A. {0}: \"L\" (D)\nB. {0}: \"' || {1} || '\" (' || {2} || ')\nF. None of above.'"


def _two(label: Column, about: Column) -> Column:
    option = lambda a, b: F.struct(a.alias("label"), b.alias("description"))
    return F.array(option(F.lit("L"), F.lit("D")), option(label, about))


def _spo() -> tuple[Column, Column, Column]:
    return F.col("subject_label"), F.col("predicate_label"), F.col("object_label")


_PROMPTS: dict[str, tuple[Callable[[], Column], str]] = {
    "ner": (lambda: prompts.ner(*_spo()), f"'Phrase: ' || {_S('object_label')} || ' | Statement: ' || {_STATEMENT}"),
    "ned1": (lambda: prompts.ned1(*_spo(), _two(F.col("subject_label"), F.col("object_label"))), f"'Target: ' || {_S('object_label')} || '\nStatement: ' || {_STATEMENT} || '\nOptions:\n' || {_ONE.format('Entity', 'subject_label', 'object_label')} || '\nG. Unsure'"),
    "nedg": (lambda: prompts.nedg(*_spo()), f"'Entity: ' || {_S('object_label')} || '\nStatement: ' || {_STATEMENT}"),
    "ned2": (lambda: prompts.ned2(F.col("object_label"), F.col("object_description"), _two(F.col("subject_label"), F.col("object_label"))), f"'Target: ' || {_S('object_label')} || '\nDescription: ' || {_S('object_description')} || '\nOptions:\n' || {_ONE.format('Entity', 'subject_label', 'object_label')}"),
    "pd": (lambda: prompts.pd(*_spo(), _two(F.col("predicate_label"), F.col("object_label"))), f"'Relation: ' || {_S('predicate_label')} || '\nStatement: ' || {_STATEMENT} || '\nOptions:\n' || {_ONE.format('Relation', 'predicate_label', 'object_label')}"),
    "pdg": (lambda: prompts.pdg(*_spo()), f"CASE WHEN length(predicate_label) > 1 THEN 'Relation: ' || predicate_label ELSE 'Relation: ' || {_S('predicate_label')} || '\nStatement: ' || {_STATEMENT} END"),
    "pdg_triple": (lambda: prompts.pdg(F.col("subject_label"), F.substring("predicate_label", 1, 1), F.col("object_label")), f"'Relation: ' || substr({_S('predicate_label')}, 1, 1) || '\nStatement: [' || {_S('subject_label')} || ', ' || substr({_S('predicate_label')}, 1, 1) || ', ' || {_S('object_label')} || ']'"),
    "cd": (lambda: prompts.cd(*_spo(), _two(F.col("object_label"), F.col("subject_label"))), f"'Class: ' || {_S('object_label')} || '\nStatement: ' || {_STATEMENT} || '\nOptions:\n' || {_ONE.format('Class', 'object_label', 'subject_label')}"),
    "cdg": (lambda: prompts.cdg(F.col("object_label")), f"'Class: ' || {_S('object_label')}"),
}
for _stage, (_build, _sql) in _PROMPTS.items():

    @query(f"build_prompt_{_stage}", f"SELECT triple_id, {_sql} AS prompt FROM t_")
    def _(spark: SparkSession, root: str, build=_build) -> DataFrame:
        return at(spark, root, "triple").select("triple_id", build().alias("prompt"))


@query("build_prompt_elicitation", f"SELECT id, 'Subject: ' || {_S('label')} || '\nDescription of subject: ' || {_S('description')} AS prompt FROM e_")
def build_prompt_elicitation(spark: SparkSession, root: str) -> DataFrame:
    return at(spark, root, "entity").select("id", prompts.elicitation(F.col("label"), F.col("description")).alias("prompt"))


_SYSTEM = prompts.SYSTEM["ner"].replace("\\", "\\\\").replace('"', '\\"').replace("'", "''")
_USER = f"to_json('Phrase: ' || {_S('object_label')} || ' | Statement: ' || {_STATEMENT})::VARCHAR"
_REQUEST = f"""SELECT '{{"custom_id":"' || triple_id || '","method":"POST","url":"/v1/responses","body":{{"model":"model","input":[{{"role":"developer","content":"{_SYSTEM}"}},{{"role":"user","content":' || {_USER} || '}}],"reasoning":{{"effort":"minimal"}},"text":{{"verbosity":"low","format":{{"type":"json_object"}}}},"max_output_tokens":256}}}}' AS value FROM t_ WHERE {_READY_SQL["ner"]}"""
_CHAT = f"""SELECT '{{"custom_id":"' || triple_id || '","method":"POST","url":"/v1/chat/completions","body":{{"model":"model","messages":[{{"role":"user","content":"{_SYSTEM}\\n\\n' || substr({_USER}, 2) || '}}],"max_tokens":256,"response_format":{{"type":"json_object"}}}}}}' AS value FROM t_ WHERE {_READY_SQL["ner"]}"""


@query("request_lines", _REQUEST)
def request_lines(spark: SparkSession, root: str) -> DataFrame:
    user = prompts.ner(*_spo())
    return queues.ready(table(spark, root, "triple"), "ner").select(prompts.request("ner", F.col("triple_id"), user).alias("value"))


@query("chat_request_lines", _CHAT)
def chat_request_lines(spark: SparkSession, root: str) -> DataFrame:
    return request_lines(spark, root).select(prompts.chat_request(F.col("value"), merge_system=True).alias("value"))


# all stages: S3, S6, X1. Each asks about the facts that wait for it; classes are asked about with the facts themselves.
_FORM_SQL = {
    "elicitation": '{"type":"json_schema","name":"facts","strict":true,"schema":{"type":"object","properties":{"facts":{"type":"array","items":{"type":"object","properties":{"subject":{"type":"string"},"predicate":{"type":"string"},"object":{"type":"string"}},"required":["subject","predicate","object"],"additionalProperties":false}}},"required":["facts"],"additionalProperties":false}}',
    "ner": '{"type":"json_object"}',
}
_CHAT_FORM_SQL = {
    "elicitation": ',"response_format":{"type":"json_schema","json_schema":{"name":"facts","schema":{"additionalProperties":false,"properties":{"facts":{"items":{"additionalProperties":false,"properties":{"object":{"type":"string"},"predicate":{"type":"string"},"subject":{"type":"string"}},"required":["subject","predicate","object"],"type":"object"},"type":"array"}},"required":["facts"],"type":"object"},"strict":true}}',
    "ner": ',"response_format":{"type":"json_object"}',
}
_WAITING = {"cd": "predicate_id = 'P0'", "cdg": "predicate_id = 'P0'"}


def _request_sql(stage: str, chat: bool) -> str:
    tokens, effort, temperature = prompts.LIMITS[stage]
    system = prompts.SYSTEM[stage].replace("\\", "\\\\").replace('"', '\\"').replace("'", "''")
    key, table_, user = ("id", "e_", f"'Subject: ' || {_S('label')} || '\nDescription of subject: ' || {_S('description')}") if stage == "elicitation" else ("triple_id", "t_", _PROMPTS[stage][1])
    where, said, warm = _WAITING.get(stage) or _READY_SQL[stage], f"to_json({user})::VARCHAR", "" if temperature is None else f',"temperature":{temperature}'
    if chat:
        warm = "" if temperature is None else f',"temperature":{float(temperature)}'
        body = f"""{{"model":"model","messages":[{{"role":"system","content":"{system}"}},{{"role":"user","content":' || {said} || '}}],"max_tokens":{tokens}{warm}{_CHAT_FORM_SQL.get(stage, "")}}}"""
    else:
        body = f"""{{"model":"model","input":[{{"role":"developer","content":"{system}"}},{{"role":"user","content":' || {said} || '}}],"reasoning":{{"effort":"{effort}"}},"text":{{"verbosity":"low","format":{_FORM_SQL.get(stage, '{"type":"text"}')}}},"max_output_tokens":{tokens}{warm}}}"""
    return f"""SELECT '{stage}' AS stage, '{{"custom_id":"' || {key} || '","method":"POST","url":"{"/v1/chat/completions" if chat else "/v1/responses"}","body":{body}}}' AS value FROM {table_} WHERE {where}"""


@query("request_lines_all", " UNION ALL ".join(_request_sql(stage, False) for stage in _READY_SQL))
def request_lines_all(spark: SparkSession, root: str) -> DataFrame:
    """The request lines of all nine stages."""
    facts, whole = at(spark, root, "triple"), None
    for stage in _READY_SQL:
        if stage == "elicitation":
            items, key, user = queues.ready(at(spark, root, "entity"), stage), "id", prompts.elicitation(F.col("label"), F.col("description"))
        else:
            items, key, user = facts.filter(_WAITING[stage]) if stage in _WAITING else queues.ready(facts, stage), "triple_id", _PROMPTS[stage][0]()
        lines = items.select(F.lit(stage).alias("stage"), prompts.request(stage, F.col(key), user).alias("value"))
        whole = lines if whole is None else whole.unionByName(lines)
    return whole


@query("chat_request_lines_all", " UNION ALL ".join(_request_sql(stage, True) for stage in _READY_SQL))
def chat_request_lines_all(spark: SparkSession, root: str) -> DataFrame:
    return request_lines_all(spark, root).select("stage", prompts.chat_request(F.col("value")).alias("value"))


@query("normalised_responses", f"SELECT triple_id AS custom_id, coalesce({TRIM.format('object_label')}, '') AS text FROM t_")
def normalised_responses(spark: SparkSession, root: str) -> DataFrame:
    """Chat response lines, brought into the form of the others and read: S5."""
    message = F.struct(F.struct(F.concat(F.lit("<think>x</think>"), F.coalesce("object_label", F.lit(""))).alias("content")).alias("message"))
    body = F.struct(F.array(message).alias("choices"), F.lit("m").alias("model"))
    line = F.to_json(F.struct(F.col("triple_id").alias("custom_id"), F.struct(body.alias("body")).alias("response")))
    return jsonl.responses(at(spark, root, "triple").select(jsonl.normalised(line).alias("value")))


@query("vector_metadata", "SELECT kind, count(DISTINCT embedding_index) AS vector_count, max(len(embedding)) AS embedding_dim FROM label_vector GROUP BY 1")
def vector_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Vectors of each kind and their length: S12."""
    found = table(spark, root, "label_vector")
    return found.groupBy("kind").agg(F.count_distinct("embedding_index").alias("vector_count"), F.max(F.size("embedding")).cast("long").alias("embedding_dim"))


@query("facts_of_entities", "SELECT t_.triple_id, e_.label, e_.status FROM t_ JOIN e_ ON e_.id = t_.object_id")
def facts_of_entities(spark: SparkSession, root: str) -> DataFrame:
    """The entity behind each object id: F12, as a join in place of point lookups."""
    entities = at(spark, root, "entity").select(F.col("id").alias("object_id"), "label", "status")
    return at(spark, root, "triple").select("triple_id", "object_id").join(entities, "object_id").select("triple_id", "label", "status")


# --- outcomes and changes: M3-M11, M15, C6 ---------------------------------------------------------------------------

_NO = n("triple_id")


def _scripted(df: DataFrame, key: str, every: list[str], **extra: Column) -> DataFrame:
    """An outcome for each row by the number of its id."""
    number = ids.num(F.col(key))
    outcome = F.try_element_at(F.array(*[F.lit(o) for o in every]), (number % len(every) + 1).cast("int"))
    return df.select(key, outcome.alias("outcome"), *[c.alias(k) for k, c in extra.items()])


def _script_sql(every: list[str], key: str = "triple_id") -> str:
    return f"CASE {n(key)} % {len(every)} " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(every)) + " END"


def _after(change: delta.Delta, name: str, df: DataFrame, *columns: str) -> DataFrame:
    return change.apply(name, df, KEY[name]).select(KEY[name], *columns)


_NER = ["text", "text", "failed"]


@query(
    "apply_ner",
    f"""SELECT triple_id, CASE WHEN NOT r THEN object_type WHEN o = 'failed' THEN object_type WHEN {_NO} % 2 = 0 THEN 'ne' ELSE 'literal' END AS object_type,
    CASE WHEN NOT r THEN object_status WHEN o = 'failed' THEN 'generated' WHEN {_NO} % 2 = 0 THEN 'ner_finished' ELSE 'finished' END AS object_status
    FROM (SELECT *, {_READY_SQL["ner"]} AS r, {_script_sql(_NER)} AS o FROM t_)""",
)
def apply_ner(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    found = _scripted(queues.ready(state["triple"], "ner"), "triple_id", _NER, is_ne=ids.num(F.col("triple_id")) % 2 == 0)
    return _after(outcomes.apply_ner(state, found), "triple", state["triple"], "object_type", "object_status")


_NED = ["pick", "none", "unsure", "failed", "pick"]
_PICKED = f"'E' || CAST({_NO} % 50 AS VARCHAR)"
_DUP = """SELECT triple_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, subject_label, predicate_id, predicate_label, picked, object_label ORDER BY triple_id) AS nth FROM q) p
    WHERE nth > 1 OR EXISTS (SELECT 1 FROM t_ s WHERE s.subject_id = p.subject_id AND s.subject_label = p.subject_label AND s.predicate_id IS NOT DISTINCT FROM p.predicate_id AND s.predicate_label = p.predicate_label AND s.object_id = p.picked AND s.object_label = p.object_label)"""


@query(
    "apply_ned1",
    f""", x AS (SELECT *, {_READY_SQL["ned1"]} AS r, {_script_sql(_NED)} AS o, {_PICKED} AS picked FROM t_), q AS (SELECT * FROM x WHERE r AND o = 'pick'), dup AS ({_DUP})
    SELECT triple_id, CASE WHEN r AND o = 'pick' THEN picked WHEN r AND o = 'unsure' THEN 'unclear NED1' ELSE object_id END AS object_id,
    CASE WHEN NOT r THEN object_status WHEN o = 'none' THEN 'ned_finished1' WHEN o = 'failed' THEN 'ner_finished' ELSE 'finished' END AS object_status
    FROM x WHERE triple_id NOT IN (SELECT triple_id FROM dup)""",
)
def apply_ned1(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    picked = F.concat(F.lit("E"), (ids.num(F.col("triple_id")) % 50).cast("string"))
    found = _scripted(queues.ready(state["triple"], "ned1"), "triple_id", _NED, picked=picked)
    return _after(outcomes.apply_ned1(state, found), "triple", state["triple"], "object_id", "object_status")


_TEXT = ["text", "failed", "text"]


@query(
    "apply_nedg",
    f"""SELECT triple_id, CASE WHEN r AND o = 'text' THEN 'About ' || object_label ELSE object_description END AS object_description, CASE WHEN NOT r THEN object_status WHEN o = 'text' THEN 'dg_finished' ELSE 'ned_finished1' END AS object_status
    FROM (SELECT *, {_READY_SQL["nedg"]} AS r, {_script_sql(_TEXT)} AS o FROM t_)""",
)
def apply_nedg(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    found = _scripted(queues.ready(state["triple"], "nedg"), "triple_id", _TEXT, text=F.concat(F.lit("About "), "object_label"))
    return _after(outcomes.apply_nedg(state, found), "triple", state["triple"], "object_description", "object_status")


_NED2O = ["none", "pick", "failed"]
_NEW = f"(SELECT * FROM t_ WHERE {_READY_SQL['ned2']} AND {_script_sql(_NED2O)} = 'none')"


def _equal(table: str, new: str, value: str, safe: bool) -> str:
    """Whether a row of ``table`` has the signature that row ``p`` gets."""
    other = " AND ".join(f"s.{c} = p.{c}" for c in SIGNATURE if c not in (new, "predicate_id"))
    predicate = f"s.predicate_id {'IS NOT DISTINCT FROM' if safe else '='} p.predicate_id AND " if new != "predicate_id" else ""
    return f"EXISTS (SELECT 1 FROM {table} s WHERE {predicate}s.{new} = p.{value} AND {other})"


@query(
    "apply_ned2",
    f""", u AS ({_upsert_sql(_NEW, "triple_id", "object_label", "object_description", "e_", "E")}),
    q1 AS (SELECT t_.*, u.id AS oid, row_number() OVER (PARTITION BY subject_id, subject_label, predicate_id, predicate_label, u.id, object_label ORDER BY triple_id) AS nth FROM t_ JOIN u USING (triple_id)),
    d1 AS (SELECT triple_id FROM q1 p WHERE nth > 1 OR {_equal("t_", "object_id", "oid", False)}),
    t1 AS (SELECT t_.* REPLACE (coalesce(oid, t_.object_id) AS object_id, CASE WHEN oid IS NULL THEN t_.object_status ELSE 'finished' END AS object_status) FROM t_ LEFT JOIN (SELECT triple_id, oid FROM q1) USING (triple_id) WHERE triple_id NOT IN (FROM d1)),
    q2 AS (SELECT *, row_number() OVER (PARTITION BY subject_id, subject_label, predicate_id, predicate_label, picked, object_label ORDER BY triple_id) AS nth FROM (SELECT *, {_PICKED} AS picked FROM t1 WHERE {_READY_SQL["ned2"]} AND {_script_sql(_NED2O)} = 'pick')),
    d2 AS (SELECT triple_id FROM q2 p WHERE nth > 1 OR {_equal("t1", "object_id", "picked", True)})
    SELECT triple_id, coalesce(picked, object_id) AS object_id, CASE WHEN picked IS NULL THEN object_status ELSE 'finished' END AS object_status
    FROM t1 LEFT JOIN (SELECT triple_id, picked FROM q2) USING (triple_id) WHERE triple_id NOT IN (FROM d2)""",
)
def apply_ned2(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    picked = F.concat(F.lit("E"), (ids.num(F.col("triple_id")) % 50).cast("string"))
    found = _scripted(queues.ready(state["triple"], "ned2"), "triple_id", _NED2O, picked=picked)
    return _after(outcomes.apply_ned2(state, found), "triple", state["triple"], "object_id", "object_status")


_PD = ["pick", "none", "failed", "pick"]
_PPICK = f"CASE WHEN {_NO} % 8 = 0 THEN 'P0' WHEN {_NO} % 8 = 7 THEN NULL ELSE 'P' || CAST({_NO} % 10 AS VARCHAR) END"


@query(
    "apply_pd",
    f"""SELECT triple_id, CASE WHEN r AND o = 'pick' THEN coalesce(picked, predicate_id) ELSE predicate_id END AS predicate_id,
    CASE WHEN NOT r THEN predicate_status WHEN o = 'none' THEN 'pd_finished' WHEN o = 'pick' AND picked IS NOT NULL THEN 'finished' ELSE 'generated' END AS predicate_status,
    CASE WHEN r AND o = 'pick' AND picked = 'P0' THEN 'class' ELSE object_type END AS object_type, CASE WHEN r AND o = 'pick' AND picked = 'P0' THEN 'finished' ELSE object_status END AS object_status
    FROM (SELECT *, {_READY_SQL["pd"]} AS r, {_script_sql(_PD)} AS o, {_PPICK} AS picked FROM t_)""",
)
def apply_pd(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    number = ids.num(F.col("triple_id"))
    picked = F.when(number % 8 == 0, "P0").when(number % 8 == 7, None).otherwise(F.concat(F.lit("P"), (number % 10).cast("string")))
    found = _scripted(queues.ready(state["triple"], "pd"), "triple_id", _PD, picked=picked)
    return _after(outcomes.apply_pd(state, found), "triple", state["triple"], "predicate_id", "predicate_status", "object_type", "object_status")


_RELATIONS = f"(SELECT *, 'Relation ' || predicate_label AS about FROM t_ WHERE {_READY_SQL['pdg']} AND {_script_sql(_TEXT)} = 'text')"


@query(
    "apply_pdg",
    f""", u AS ({_upsert_sql(_RELATIONS, "triple_id", "predicate_label", "about", "p_", "P")}),
    q AS (SELECT t_.*, u.id AS pid, row_number() OVER (PARTITION BY subject_id, subject_label, u.id, predicate_label, object_id, object_label ORDER BY triple_id) AS nth FROM t_ JOIN u USING (triple_id)),
    dup AS (SELECT triple_id FROM q p WHERE nth > 1 OR {_equal("t_", "predicate_id", "pid", False)})
    SELECT triple_id, coalesce(pid, t_.predicate_id) AS predicate_id, CASE WHEN pid IS NULL THEN t_.predicate_status ELSE 'finished' END AS predicate_status
    FROM t_ LEFT JOIN (SELECT triple_id, pid FROM q) USING (triple_id) WHERE triple_id NOT IN (FROM dup)""",
)
def apply_pdg(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    found = _scripted(queues.ready(state["triple"], "pdg"), "triple_id", _TEXT, text=F.concat(F.lit("Relation "), "predicate_label"))
    return _after(outcomes.apply_pdg(state, found), "triple", state["triple"], "predicate_id", "predicate_status")


_CNO = n("original_triple_id")


@query(
    "apply_cd",
    f"""SELECT original_triple_id, CASE WHEN r AND o = 'pick' THEN coalesce(picked, concept_id) ELSE concept_id END AS concept_id,
    CASE WHEN NOT r THEN status WHEN o = 'none' THEN 'cd_finished' WHEN o = 'pick' AND picked IS NOT NULL THEN 'finished' ELSE 'generated' END AS status
    FROM (SELECT *, {_READY_SQL["cd"]} AS r, {_script_sql(_PD, "original_triple_id")} AS o, CASE WHEN {_CNO} % 8 <> 7 THEN 'C' || CAST({_CNO} % 10 AS VARCHAR) END AS picked FROM i_)""",
)
def apply_cd(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    number = ids.num(F.col("original_triple_id"))
    picked = F.when(number % 8 != 7, F.concat(F.lit("C"), (number % 10).cast("string")))
    found = _scripted(queues.ready(state["instance_triple"], "cd"), "original_triple_id", _PD, picked=picked)
    return _after(outcomes.apply_cd(state, found), "instance_triple", state["instance_triple"], "concept_id", "status")


_CITEMS = f"(SELECT *, 'Class ' || concept_label AS about FROM i_ WHERE status = 'cd_finished' AND {_script_sql(_TEXT, 'original_triple_id')} = 'text')"


@query(
    "apply_cdg",
    f"""SELECT original_triple_id, coalesce(u.id, concept_id) AS concept_id, CASE WHEN u.id IS NOT NULL THEN 'finished' ELSE status END AS status
    FROM i_ LEFT JOIN ({_upsert_sql(_CITEMS, "original_triple_id", "concept_label", "about", "c_", "C")}) u USING (original_triple_id)""",
)
def apply_cdg(spark: SparkSession, root: str) -> DataFrame:
    state = state_of(spark, root)
    found = _scripted(queues.ready(state["instance_triple"], "cdg"), "original_triple_id", _TEXT, text=F.lit("")).join(state["instance_triple"].select("original_triple_id", "concept_label"), "original_triple_id")
    found = found.withColumn("text", F.concat(F.lit("Class "), "concept_label")).drop("concept_label")
    return _after(outcomes.apply_cdg(state, found), "instance_triple", state["instance_triple"], "concept_id", "status")


_RESETS = {"object_status": {"onned1": "ner_finished", "ondg": "ned_finished1", "onned2": "dg_finished"}}


@query("reset_unanswered", "SELECT triple_id, CASE " + " ".join(f"WHEN object_type = 'ne' AND object_status = '{a}' THEN '{b}'" for a, b in _RESETS["object_status"].items()) + " ELSE object_status END AS object_status FROM t_")
def reset_unanswered(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    for stage in ("ned1", "nedg", "ned2"):
        _, column, _, back = outcomes.RESET[stage]
        facts = delta.update_where(facts, outcomes.unanswered(stage), **{column: back})
    return facts.select("triple_id", "object_status")


@query("reset_failed_batch", "SELECT triple_id, CASE WHEN object_status = 'onner' AND ner_batch_id IN (SELECT id FROM b_ WHERE status IN ('failed', 'expired', 'cancelled')) THEN 'generated' ELSE object_status END AS object_status FROM t_")
def reset_failed_batch(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    dead = at(spark, root, "batch_job").filter(F.col("status").isin("failed", "expired", "cancelled")).select(F.col("id").alias("ner_batch_id"))
    held = facts.filter("object_status = 'onner'").join(dead, "ner_batch_id", "left_semi").select("triple_id")
    return delta.update_constant(facts, held, "triple_id", object_status="generated").select("triple_id", "object_status")


@query("delete_duplicates", f"SELECT t_.triple_id FROM t_ JOIN (SELECT min(triple_id) AS triple_id FROM t_ GROUP BY {_SIG}) USING (triple_id)")
def delete_duplicates(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    first = dedup.keep_first(facts, SIGNATURE, "triple_id")
    return delta.delete(facts, facts.select("triple_id").join(first, "triple_id", "left_anti"), "triple_id").select("triple_id")


@query("update_by_map", "SELECT triple_id, coalesce(pid, predicate_id) AS predicate_id FROM t_ LEFT JOIN (" + _PMAP + ") USING (predicate_label)")
def update_by_map(spark: SparkSession, root: str) -> DataFrame:
    facts = at(spark, root, "triple")
    changes = facts.select("triple_id", "predicate_label").join(reuse.label_map(facts, "predicate_label", "predicate_id", 1), "predicate_label").select("triple_id", "predicate_id")
    return delta.update_map(facts, changes, "triple_id").select("triple_id", "predicate_id")


@query("replace_links", f"SELECT triple_id, candidate, position FROM {_LINKS} WHERE {_NO} % 200 <> 0 UNION ALL SELECT DISTINCT triple_id, 'E0', 0 FROM {_LINKS} WHERE {_NO} % 200 = 0")
def replace_links(spark: SparkSession, root: str) -> DataFrame:
    links = _links(spark, root)
    new = links.filter(ids.num(F.col("triple_id")) % 200 == 0).select("triple_id", F.lit("E0").alias("candidate"), F.lit(0).alias("position")).distinct()
    return delta.replace_links(links, new, "triple_id")


@query("outcome_counts", f"SELECT CASE WHEN o <> 'text' THEN o WHEN {_NO} % 2 = 0 THEN 'ne' ELSE 'literal' END AS outcome, count(*) AS n FROM (SELECT *, {_script_sql(_NER)} AS o FROM t_ WHERE {_READY_SQL['ner']}) GROUP BY 1")
def outcome_counts(spark: SparkSession, root: str) -> DataFrame:
    """Outcomes of the scripted recognition, counted: A11."""
    found = _scripted(queues.ready(at(spark, root, "triple"), "ner"), "triple_id", _NER, is_ne=ids.num(F.col("triple_id")) % 2 == 0)
    return outcomes.counts(found)


@query("known_facts", "SELECT DISTINCT subject_id, predicate_label, object_label FROM t_ a WHERE EXISTS (SELECT 1 FROM t_ b WHERE b.triple_id <> a.triple_id AND a.subject_id = b.subject_id AND a.predicate_label = b.predicate_label AND a.object_label = b.object_label)")
def known_facts(spark: SparkSession, root: str) -> DataFrame:
    """Facts stored under several ids: J4. A null never equals."""
    keys = ["subject_id", "predicate_label", "object_label"]
    facts = at(spark, root, "triple").select("triple_id", *keys).dropna(subset=keys)
    return facts.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n")


@query("insert_or_ignore_all", "SELECT triple_id FROM t_ WHERE predicate_id = 'P0' OR predicate_label <> 'instanceOf' EXCEPT SELECT original_triple_id FROM i_")
def insert_or_ignore_all(spark: SparkSession, root: str) -> DataFrame:
    """Ids of facts offered to the class facts, those there already ignored: M2."""
    offered = at(spark, root, "triple").filter("predicate_id = 'P0' or predicate_label <> 'instanceOf'").select(F.col("triple_id").alias("original_triple_id"))
    return dedup.insert_or_ignore(offered, at(spark, root, "instance_triple"), ["original_triple_id"]).select(F.col("original_triple_id").alias("triple_id"))


_REPLAYED = """SELECT * FROM (VALUES
    ('T0', 'instanceOf', 'P0', 'finished', 'human', NULL, 'class', 'finished', NULL), ('T1', 'bornIn', 'P1', 'finished', 'Port Vell', 'E1', 'ne', 'finished', 'A harbour.'),
    ('T2', 'birthYear', 'P2', 'finished', '1815', NULL, 'literal', 'finished', NULL))
    AS r(triple_id, predicate_label, predicate_id, predicate_status, object_label, object_id, object_type, object_status, object_description)"""


@query("full_round_replay", _REPLAYED)
def full_round_replay(spark: SparkSession, root: str) -> DataFrame:
    """Facts after rounds over a small scripted knowledge base, answered at once. It reads no table: what a round does to the
    tables is in the queries of its stages."""
    from factloom.plans.replay import replayed

    return replayed(spark)


@query("batch_round_replay", _REPLAYED)
def batch_round_replay(spark: SparkSession, root: str) -> DataFrame:
    """The same knowledge base built in batch mode, each batch answered between two rounds."""
    from factloom.plans.replay import replayed

    return replayed(spark, 9, True)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
