"""What answers change. Each function takes the state and outcomes and gives a Delta.

Outcomes have ``triple_id`` (or ``original_triple_id``), ``outcome`` (pick, none, unsure, text, failed) and what it carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.dedup import keep_first, resolve_picks, same
from factloom.operators.delta import Delta
from factloom.operators.ingest import class_facts
from factloom.operators.upsert import upsert_pairs
from factloom.runtime import staged
from factloom.schema import SIGNATURE, UNSURE

State = dict[str, DataFrame]
TRIPLE, CLASS = "triple_id", "original_triple_id"


def _set(rows: DataFrame, key: str, **values) -> DataFrame:
    return rows.select(key, *[(v if not isinstance(v, str) else F.lit(v)).alias(c) for c, v in values.items()])


def apply_ner(state: State, outcomes: DataFrame) -> Delta:
    """``is_ne``: named entities go on to disambiguation, the rest are literals and done; a failure goes back."""
    named, failed = F.col("is_ne"), F.col("outcome") == "failed"
    kind = F.when(failed, F.lit(None)).when(named, "ne").otherwise("literal")
    status = F.when(failed, "generated").when(named, "ner_finished").otherwise("finished")
    return Delta(updates={"triple": [_set(outcomes, TRIPLE, object_type=kind, object_status=status)]})


def _picked(state: State, picks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Updates and deletions for facts with a picked object."""
    rows = state["triple"].drop("object_id").join(picks.select(TRIPLE, F.col("picked").alias("object_id")), TRIPLE)
    marked = staged(resolve_picks(rows, state["triple"]).select(TRIPLE, "object_id", "is_duplicate"))  # used twice
    kept = marked.filter(~F.col("is_duplicate"))
    return _set(kept, TRIPLE, object_id=F.col("object_id"), object_status="finished"), marked.filter("is_duplicate").select(TRIPLE)


def apply_ned1(state: State, outcomes: DataFrame) -> Delta:
    """none goes on to a description; unsure is done with a sentinel; a pick is the object unless it makes a duplicate;
    a pick out of range (no ``picked``) is ignored; a failure goes back."""
    o = F.col("outcome")
    plain = outcomes.filter(o.isin("none", "unsure", "failed"))
    status = F.when(o == "none", "ned_finished1").when(o == "unsure", "finished").otherwise("ner_finished")
    changes = _set(plain, TRIPLE, object_id=F.when(o == "unsure", UNSURE), object_status=status)
    updates, deletes = _picked(state, outcomes.filter((o == "pick") & F.col("picked").isNotNull()))
    return Delta(updates={"triple": [changes, updates]}, deletes={"triple": deletes})


def apply_nedg(state: State, outcomes: DataFrame) -> Delta:
    """``text`` is the description; a failure goes back."""
    text = F.col("outcome") == "text"
    changes = _set(outcomes, TRIPLE, object_status=F.when(text, "dg_finished").otherwise("ned_finished1"), object_description=F.when(text, F.col("text")))
    return Delta(updates={"triple": [changes]})


def apply_ned2(state: State, outcomes: DataFrame) -> Delta:
    """none makes an entity of the label and description, or takes the one that is there; its fact goes if its signature is
    there already (a null never matches). Picks follow, against the facts with those changes. A failure goes back."""
    o = F.col("outcome")
    asked = outcomes.filter((o == "none") | (o == "pick") & F.col("picked").isNotNull()).select(TRIPLE, "outcome", "picked")
    rows = staged(state["triple"].join(asked, TRIPLE))
    fresh = rows.filter(o == "none").drop("picked", "outcome")
    ids, new = upsert_pairs(fresh.select(TRIPLE, F.col("object_label").alias("label"), F.col("object_description").alias("description")), state["entity"], "E")
    added = new.select("id", F.lit("unexplored").alias("status"), "description", "label", "embedding_index", "first_appeared", F.lit(None).cast("string").alias("explored_batch_id"), F.current_timestamp().alias("created_at"))
    made = fresh.drop("object_id").join(ids.withColumnRenamed("id", "object_id"), TRIPLE).select(TRIPLE, *SIGNATURE, F.lit(True).alias("made"))
    chosen = rows.filter(o == "pick").select(TRIPLE, *[F.col("picked").alias(c) if c == "object_id" else F.col(c) for c in SIGNATURE], F.lit(False).alias("made"))
    resolved = staged(made.unionByName(chosen))
    # one pass over the facts for both: which of them have the signatures that come
    facts = state["triple"].select(F.col(TRIPLE).alias("other"), *SIGNATURE)
    met = resolved.alias("r").join(facts.alias("t"), same("r", "t", SIGNATURE, {"predicate_id"})).select(F.col(f"r.{TRIPLE}").alias(TRIPLE), "other", "made", F.col("r.predicate_id").alias("predicate_id"))
    met = staged(met.filter(~F.col("made") | F.col("predicate_id").isNotNull()))
    made, chosen = resolved.filter("made"), resolved.filter("not made")
    taken = met.filter("made").select(TRIPLE).distinct()
    first = keep_first(made, SIGNATURE, TRIPLE).join(taken, TRIPLE, "left_anti")
    kept = staged(made.join(first, TRIPLE, "left_semi"))
    # picks meet the facts as they are by then: those that were made have their new signature or are gone
    before = met.filter(~F.col("made")).join(made.select(F.col(TRIPLE).alias("other")), "other", "left_anti").select(TRIPLE)
    meanwhile = chosen.alias("r").join(kept.alias("t"), same("r", "t", SIGNATURE, {"predicate_id"}), "left_semi").select(TRIPLE)
    late = keep_first(chosen, SIGNATURE, TRIPLE).join(before.unionByName(meanwhile).distinct(), TRIPLE, "left_anti")
    done = kept.unionByName(chosen.join(late, TRIPLE, "left_semi"))
    done = staged(_set(done, TRIPLE, object_id=F.col("object_id"), object_status="finished"))
    failed = _set(outcomes.filter(o == "failed"), TRIPLE, object_status="dg_finished")
    return Delta(
        updates={"triple": [done.unionByName(failed, allowMissingColumns=True)]},
        deletes={"triple": resolved.select(TRIPLE).join(done.select(TRIPLE), TRIPLE, "left_anti")},
        inserts={"entity": added.select(*state["entity"].columns)},
    )


def apply_pd(state: State, outcomes: DataFrame) -> Delta:
    """none goes on to a description, a pick is the predicate, anything else goes back. A pick of ``instanceOf`` also makes
    the object a class, and a class fact unless there is one."""
    o = F.col("outcome")
    status = F.when(o == "none", "pd_finished").when((o == "pick") & F.col("picked").isNotNull(), "finished").otherwise("generated")
    changes = _set(outcomes, TRIPLE, predicate_id=F.when(o == "pick", F.col("picked")), predicate_status=status)
    root = state["predicate"].filter(F.col("label") == "instanceOf").agg(F.min("id").alias("picked"))
    typed = outcomes.filter(o == "pick").join(F.broadcast(root), "picked", "left_semi").select(TRIPLE)  # one row
    classes = _set(typed, TRIPLE, object_type="class", object_status="finished")
    facts = class_facts(state["triple"].join(typed, TRIPLE, "left_semi")).join(state["instance_triple"].select(CLASS), CLASS, "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in state["instance_triple"].schema if f.name not in facts.columns]
    return Delta(updates={"triple": [changes, classes]}, inserts={"instance_triple": facts.select("*", *missing)})


def apply_pdg(state: State, outcomes: DataFrame) -> Delta:
    """``text`` and the label make a predicate, or the one that is there; the fact goes if its signature is there."""
    texts = outcomes.filter(F.col("outcome") == "text")
    there = texts.join(state["triple"].drop("predicate_id"), TRIPLE)
    ids, rows = upsert_pairs(there.select(TRIPLE, F.col("predicate_label").alias("label"), F.col("text").alias("description")), state["predicate"], "P")
    named = there.join(ids.withColumnRenamed("id", "predicate_id"), TRIPLE)
    marked = staged(resolve_picks(named, state["triple"], null_safe=False).select(TRIPLE, "predicate_id", "is_duplicate"))
    failed = _set(outcomes.filter(F.col("outcome") != "text"), TRIPLE, predicate_status="pd_finished")
    return Delta(
        updates={"triple": [_set(marked.filter(~F.col("is_duplicate")), TRIPLE, predicate_id=F.col("predicate_id"), predicate_status="finished"), failed]},
        deletes={"triple": marked.filter("is_duplicate").select(TRIPLE)},
        inserts={"predicate": rows.select(*state["predicate"].columns)},
    )


def apply_cd(state: State, outcomes: DataFrame) -> Delta:
    """none goes on to a description, a pick is the class, anything else goes back."""
    o = F.col("outcome")
    status = F.when(o == "none", "cd_finished").when((o == "pick") & F.col("picked").isNotNull(), "finished").otherwise("generated")
    return Delta(updates={"instance_triple": [_set(outcomes, CLASS, concept_id=F.when(o == "pick", F.col("picked")), status=status)]})


def apply_cdg(state: State, outcomes: DataFrame) -> Delta:
    """``text`` and the label make a class, or the one that is there."""
    texts = outcomes.filter(F.col("outcome") == "text")
    there = texts.join(state["instance_triple"].select(CLASS, "concept_label"), CLASS)
    ids, rows = upsert_pairs(there.select(CLASS, F.col("concept_label").alias("label"), F.col("text").alias("description")), state["concept"], "C", CLASS)
    failed = _set(outcomes.filter(F.col("outcome") != "text"), CLASS, status="cd_finished")
    return Delta(updates={"instance_triple": [_set(ids, CLASS, concept_id=F.col("id"), status="finished"), failed]}, inserts={"concept": rows.select(*state["concept"].columns)})


def apply_elicitation(state: State, outcomes: DataFrame) -> Delta:
    """``id``: an answered entity is explored, a failed one waits again."""
    status = F.when(F.col("outcome") == "failed", "unexplored").otherwise("explored")
    return Delta(updates={"entity": [_set(outcomes, "id", status=status)]})


APPLY = {"elicitation": apply_elicitation, "ner": apply_ner, "ned1": apply_ned1, "nedg": apply_nedg, "ned2": apply_ned2, "pd": apply_pd, "pdg": apply_pdg, "cd": apply_cd, "cdg": apply_cdg}
#: Table, status column, status while a batch is out and status to go back to, by stage.
RESET = {
    "elicitation": ("entity", "status", "exploring", "unexplored"), "ner": ("triple", "object_status", "onner", "generated"), "ned1": ("triple", "object_status", "onned1", "ner_finished"),
    "nedg": ("triple", "object_status", "ondg", "ned_finished1"), "ned2": ("triple", "object_status", "onned2", "dg_finished"), "pd": ("triple", "predicate_status", "onpd", "generated"),
    "pdg": ("triple", "predicate_status", "ondg", "pd_finished"), "cd": ("instance_triple", "status", "oncd", "generated"), "cdg": ("instance_triple", "status", "ondg", "cd_finished"),
}


def unanswered(stage: str) -> Column:
    """The items that a batch of a stage holds; objects of facts only where they are named entities, but for their recognition."""
    _, column, out, _ = RESET[stage]
    held = F.col(column) == out
    return held & (F.col("object_type") == "ne") if stage in ("ned1", "nedg", "ned2") else held


def counts(outcomes: DataFrame) -> DataFrame:
    """``outcome, n``: how many items each outcome has; of recognised phrases, named entities and literals apart. A pick without its
    candidate is ``out of range``."""
    name = F.col("outcome")
    if "is_ne" in outcomes.columns:
        name = F.when(name != "text", name).when(F.col("is_ne"), "ne").otherwise("literal")
    if "picked" in outcomes.columns:
        name = F.when((name == "pick") & F.col("picked").isNull(), "out of range").otherwise(name)
    return outcomes.groupBy(name.alias("outcome")).agg(F.count("*").alias("n"))
