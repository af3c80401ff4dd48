"""The round loop: what waits is asked, answers change the store, until nothing moves."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import parsing, prompts
from factloom.functions.ids import next_number, num
from factloom.operators import candidates, dedup, outcomes, queues, reuse, vectors
from factloom.operators.delta import Delta, replace_links, update_where
from factloom.operators.ingest import ingest
from factloom.responder import BatchClient, Responder
from factloom.runtime import free, mark, staged
from factloom.schema import IN_PROCESS, JOBS, KEYS, TABLES
from factloom.sources.jsonl import responses
from factloom.sources.store import Store

log = logging.getLogger(__name__)
#: Stages that close a gate when they find work, and the stage behind each gate.
CLOSES = {"nedg": "NED", "ned2": "NED", "pdg": "PD", "cdg": "CD"}
BEHIND = {"ned1": "NED", "pd": "PD", "cd": "CD"}
#: Order within a round.
ORDER = ("nedg", "ned2", "ned1", "elicitation", "pdg", "cdg", "pd", "cd", "ner")
#: Stages that use up the quota of a round.
COUNTED = ("nedg", "elicitation", "pdg", "pd", "cd", "ner")


#: States of a batch that no answer follows.
TERMINAL = ("completed", "failed", "expired", "cancelled")
#: Items of a batch and batches a round, in batch mode.
BATCH, BATCHES = {"elicitation": 300, "ner": 1_000}, {"elicitation": 30, "ner": 10}
#: Kind of the candidates of a stage, and the table and column that keep them while a batch is out.
OPTIONS = {"ned1": ("entity", "ned1_link", "instance_node_id"), "ned2": ("entity", "ned2_link", "instance_node_id"), "pd": ("predicate", "pd_link", "predicate_id"), "cd": ("concept", "cd_link", "concept_id")}


@dataclass
class Limits:
    """Items a stage takes a round, thresholds, and when to stop. ``queue`` counts items, in batch mode batches that are out."""

    items: dict[str, int] = field(default_factory=dict)
    batch_items: int = 400
    batches: int = 5
    queue: int = 1_000_000
    entities: int = 80_000
    idle_rounds: int = 3
    reuse_more_than: int = 50
    cluster_distance: float = 0.15
    whole_predicates: int = 300
    whole_concepts: int = 100
    predicate_prefix: int = 5
    concept_prefix: int = 3


@dataclass
class Engine:
    """A store, who answers, and how labels become vectors.

    With ``batches`` requests are handed in as batches and their answers collected in later rounds; without it they are
    answered at once, but batches that are still out need a client. ``nearest`` finds neighbours as ``vectors.exact_topk``,
    which compares all, does; an index may take its place.
    """

    store: Store
    responder: Responder | None
    embedder: vectors.Embedder
    limits: Limits = field(default_factory=Limits)
    batches: BatchClient | None = None
    batchwise: bool = False
    nearest: Callable[..., DataFrame] = vectors.exact_topk
    #: Outcomes of each stage, counted: those of the last round.
    report: dict[str, dict[str, int]] = field(default_factory=dict)
    failed: bool = False

    def run(self, max_rounds: int = 100) -> list[dict[str, int]]:
        """Rounds until so many idle ones, in which nothing was done, nothing is out and nothing failed; items, or batches, taken by each stage
        in each round."""
        history, idle = [], 0
        self.recover()
        while len(history) < max_rounds and idle < self.limits.idle_rounds:
            done = self.round()
            history.append(done)
            idle = 0 if any(done.values()) or self.failed else idle + 1
        return history

    def recover(self) -> None:
        """Items of cancelled batches wait again."""
        state = self.store.state()
        stage_of = {job: stage for stage, (job, _, _) in JOBS.items()}
        for r in queues.holding_items(state["batch_job"], state).collect():  # batches, not items
            self.collected(stage_of[r["job_type"]], r["id"], "cancelled")

    def poll(self) -> tuple[int, dict[str, bool]]:
        """Batches that are still out, and the gates. Answers of those that ended are applied.

        A batch that can't be asked for is out and closes all gates; one of an unknown status is out.
        """
        opened = {r["gate"]: r["open"] for r in queues.gates(self.store.read("batch_job")).collect()}
        stage_of = {job: stage for stage, (job, _, _) in JOBS.items()}
        active = queues.in_process(self.store.read("batch_job")).select("id", "job_type", "status").collect()  # at most the queue's batches
        if self.batches is None:
            return len(active), opened
        out = 0
        for r in active:
            try:
                status = (self.batches.retrieve(r["id"]) or "").lower()
            except Exception:
                log.exception("batch %s can't be retrieved", r["id"])
                opened = dict.fromkeys(opened, False)
                out += 1
                continue
            if status not in TERMINAL:
                out += 1
                if status in IN_PROCESS and status != r["status"]:
                    self.store.commit({"batch_job": update_where(self.store.read("batch_job"), F.col("id") == r["id"], status=status)})
                elif status not in IN_PROCESS:
                    log.warning("batch %s has the unknown status %r and is taken to be running", r["id"], status)
                continue
            try:
                self.collected(stage_of[r["job_type"]], r["id"], status)
            except Exception:
                self.failed = True
                log.exception("answers of batch %s failed", r["id"])
        return out, opened

    def collected(self, stage: str, batch: str, status: str) -> None:
        """Apply the answers of a batch that ended; its items without one go back. The batch's status is set with the same commit."""
        state, since = self.store.state(), mark()
        name, key = queues.READY[stage]
        _, column, out, _ = outcomes.RESET[stage]
        items = state[name].filter((F.col(JOBS[stage][1]) == batch) & (F.col(column) == out))
        lines = self.batches.output(batch) if self.batches is not None and status == "completed" else self.store.spark.createDataFrame([], "value string")
        answers = staged(responses(lines).dropDuplicates(["custom_id"]).withColumnRenamed("custom_id", key))
        if stage in OPTIONS:
            kind, links, ident = OPTIONS[stage]
            items = items.join(candidates.ordered(state[links], key, ident, state[kind]), key, "left").withColumn("candidates", F.coalesce("candidates", _no_options()))
        items = staged(items)
        ended = update_where(state["batch_job"], F.col("id") == batch, status=status)
        if stage == "elicitation":
            self.elicited(state, items.select(key).join(answers, key, "left"), {"batch_job": ended})
        else:
            found = staged(self.parsed(stage, items, answers, key))
            self.counted(stage, found)
            self.commit(outcomes.APPLY[stage](state, found), {"batch_job": ended})
        free(self.store.spark, since)

    def sent(self, stage: str, asked: DataFrame, key: str) -> int:
        """Hand in requests as batches, and mark their items; the number of batches."""
        state, spark = self.store.state(), self.store.spark
        size = BATCH.get(stage, self.limits.batch_items)
        chunks = staged(queues.chunked(asked, key, size))
        job, column, _ = JOBS[stage]
        rows = []
        for r in chunks.select("batch_no").distinct().orderBy("batch_no").collect():  # as many as the quota has batches
            lines = chunks.filter(F.col("batch_no") == r["batch_no"]).select(F.col("request").alias("value"))
            rows.append((r["batch_no"], self.batches.create(stage, lines)))
        ids = F.broadcast(spark.createDataFrame(rows, "batch_no long, batch string"))
        name, state_column, out = outcomes.RESET[stage][:3]
        marked = chunks.join(ids, "batch_no").select(key, F.col("batch").alias(column), F.lit(out).alias(state_column))
        jobs = ids.select(F.col("batch").alias("id"), F.lit("created").alias("status"), F.lit(job).alias("job_type"))
        delta = Delta(updates={name: [marked]}, inserts={"batch_job": _filled(jobs, "batch_job")})
        tables = {n: delta.apply(n, state[n], KEYS[n][0]) for n in delta.tables}
        if stage in OPTIONS:
            _, links, ident = OPTIONS[stage]
            new = chunks.select(key, F.explode("candidates").alias("c")).select(key, F.col("c.id").alias(ident), F.col("c.position").alias("position"))
            tables[links] = replace_links(state[links].join(chunks.select(key), key, "left_anti"), new, key)
        self.store.commit(tables)
        return len(rows)

    def counted(self, stage: str, found: DataFrame) -> None:
        """Add the outcomes of a stage to the report."""
        into = self.report.setdefault(stage, {})
        for r in outcomes.counts(found).collect():
            into[r["outcome"]] = into.get(r["outcome"], 0) + r["n"]

    def round(self) -> dict[str, int]:
        """One pass over all stages. A stage that fails is logged and left for the next round."""
        self.failed, self.report = False, {}
        out, opened = self.poll()
        if opened["NED"]:
            self.reset(("ned1", "nedg", "ned2"))
        done, quota = dict.fromkeys(ORDER, 0), self.limits.queue - (out if self.batchwise else 0)
        for stage in ORDER:
            if not opened.get(BEHIND.get(stage), True) or (stage in COUNTED and quota <= 0):
                continue
            since = mark()
            try:
                done[stage] = self.stage(stage, quota)
            except Exception:
                self.failed = True
                log.exception("stage %s failed", stage)
                continue
            finally:
                free(self.store.spark, since)
            if done[stage] and stage in CLOSES:
                opened[CLOSES[stage]] = False
            if stage in COUNTED:
                quota -= done[stage]
        return done

    def reset(self, stages: tuple[str, ...]) -> None:
        """Items of batches that are gone wait again."""
        tables = {}
        for stage in stages:
            name, column, _, back = outcomes.RESET[stage]
            table, held = tables.get(name, self.store.read(name)), outcomes.unanswered(stage)
            if not table.filter(held).isEmpty():
                tables[name] = update_where(table, held, **{column: back})
        if tables:
            self.store.commit(tables)

    def stage(self, stage: str, quota: int) -> int:
        """Take what waits for a stage, ask, apply; the number of items taken, those answered from caches included."""
        state = self.store.state()
        name, key = queues.READY[stage]
        if self.batchwise:
            quota = min(quota, BATCHES.get(stage, self.limits.batches)) * BATCH.get(stage, self.limits.batch_items)
        limit = min(self.limits.items.get(stage, quota), quota)
        if stage == "elicitation":
            explored = state["entity"].filter(F.col("status") == "explored").count()
            limit = min(limit, self.limits.entities - explored)
            if limit <= 0:
                return 0
        queue = staged(queues.ready(state[name], stage, limit))
        taken = queue.count()
        if not taken:
            return 0
        queue = self.reused(stage, state, queue)
        state = self.store.state()
        asked = staged(self.requests(stage, state, queue))
        if self.batchwise:
            return self.sent(stage, asked, key) if not asked.isEmpty() else 0
        answers = staged(self.responder.answer(stage, asked.select(F.col(key).alias("custom_id"), "request")).withColumnRenamed("custom_id", key))
        if stage == "elicitation":
            self.elicited(state, answers)
        else:
            found = staged(self.parsed(stage, asked, answers, key))
            self.counted(stage, found)
            self.commit(outcomes.APPLY[stage](state, found))
        return taken

    def reused(self, stage: str, state: dict[str, DataFrame], queue: DataFrame) -> DataFrame:
        """Answer from what is known, and leave one item of those that are alike; the rest waits."""
        lim = self.limits
        if stage == "ned1":
            known = reuse.consistent_objects(state["triple"], lim.reuse_more_than).select("predicate_label", "object_label", "object_id")
            picks = queue.drop("object_id").join(known, ["predicate_label", "object_label"])
            marked = staged(dedup.resolve_picks(picks, state["triple"], null_safe=False, by_number=True))
            self.commit(_resolved(marked, "triple", "triple_id", object_id=F.col("object_id"), object_status=F.lit("finished")))
            rest = queue.join(marked, "triple_id", "left_anti")
            return self.thinned(state, rest)
        if stage == "pd":
            known = reuse.label_map(state["triple"], "predicate_label", "predicate_id", 1)
            marked = staged(dedup.apply_predicate_map(queue, state["triple"], known))
            self.commit(_resolved(marked, "triple", "triple_id", predicate_id=F.col("predicate_id"), predicate_status=F.lit("finished")))
            rest = queue.join(marked, "triple_id", "left_anti")
            first = reuse.thin(rest, "predicate_label", "triple_id", state["predicate"], lim.whole_predicates, lim.predicate_prefix)
            return staged(rest.join(first, "triple_id", "left_semi"))
        if stage == "cd":
            known = reuse.label_map(state["instance_triple"], "concept_label", "concept_id")
            marked = staged(dedup.apply_concept_map(queue, state["instance_triple"], known))
            delta = _resolved(marked, "instance_triple", "original_triple_id", concept_id=F.col("concept_id"), status=F.lit("finished"))
            delta.deletes["triple"] = delta.deletes["instance_triple"].withColumnRenamed("original_triple_id", "triple_id")
            self.commit(delta)
            rest = queue.join(marked, "original_triple_id", "left_anti")
            first = reuse.thin(rest, "concept_label", "original_triple_id", state["concept"], lim.whole_concepts, lim.concept_prefix)
            return staged(rest.join(first, "original_triple_id", "left_semi"))
        return queue

    def thinned(self, state: dict[str, DataFrame], rest: DataFrame) -> DataFrame:
        """Of labels that are alike the first; of frequent labels one fact a subject, else one in all."""
        first = reuse.thin_by_cluster(rest, state["triple"], self.embedder, self.limits.cluster_distance, self.limits.reuse_more_than)
        return staged(rest.join(first, "triple_id", "left_semi"))

    def near(self, state: dict[str, DataFrame], queue: DataFrame, key: str, label: str, kind: str) -> DataFrame:
        """``key, candidate, position``: the nearest labels of a kind for the label of each item."""
        asked = vectors.embed(queue.select(F.xxhash64(label).alias("idx"), label).distinct(), label, self.embedder).withColumn("kind", F.lit(kind))
        base = state["vector"].filter(F.col("kind") == kind).select("kind", F.col("embedding_index").alias("idx"), "embedding")
        found = self.nearest(asked, base, candidates.MOST, itself=True)
        named = found.select(F.col("query").alias("__q"), F.concat(F.lit(kind[0].upper()), F.col("neighbour").cast("string")).alias("candidate"), "position")
        return queue.select(key, F.xxhash64(label).alias("__q")).join(named, "__q").select(key, "candidate", "position")

    def requests(self, stage: str, state: dict[str, DataFrame], queue: DataFrame) -> DataFrame:
        """The queue with ``request`` and, where there are options, ``candidates``."""
        c = F.col
        key = queues.READY[stage][1]
        if stage in ("cd", "cdg"):
            queue = queue.join(state["triple"].select(c("triple_id").alias(key), "subject_label", "predicate_label", "object_label"), key)
        spo = (c("subject_label"), c("predicate_label"), c("object_label"))
        kinds = {"ned1": ("object_label", "entity"), "ned2": ("object_label", "entity"), "pd": ("predicate_label", "predicate"), "cd": ("concept_label", "concept")}
        if stage in kinds:
            label, kind = kinds[stage]
            links = self.near(state, queue, key, label, kind)
            if stage == "ned2":
                links = candidates.ned2_candidates(queue, state["entity"], links, lambda df, text: vectors.embed(df, text, self.embedder))
            queue = queue.join(candidates.ordered(links, key, "candidate", state[kind]), key, "left")
            queue = queue.withColumn("candidates", F.coalesce("candidates", _no_options()))
        user = {
            "elicitation": lambda: prompts.elicitation(c("label"), c("description")), "ner": lambda: prompts.ner(*spo), "ned1": lambda: prompts.ned1(*spo, c("candidates")),
            "nedg": lambda: prompts.nedg(*spo), "ned2": lambda: prompts.ned2(spo[2], c("object_description"), c("candidates")), "pd": lambda: prompts.pd(*spo, c("candidates")),
            "pdg": lambda: prompts.pdg(*spo), "cd": lambda: prompts.cd(*spo, c("candidates")), "cdg": lambda: prompts.cdg(c("concept_label")),
        }[stage]()
        return queue.withColumn("request", prompts.request(stage, c(key), user))

    def parsed(self, stage: str, asked: DataFrame, answers: DataFrame, key: str) -> DataFrame:
        """Outcomes of the answers; an item without one has failed."""
        joined = asked.select(key, *(["candidates"] if "candidates" in asked.columns else [])).join(answers, key, "left")
        text = F.col("text")
        if stage == "ner":
            read = parsing.ner(text)
            return joined.select(key, F.when(read.isNull(), "failed").otherwise("text").alias("outcome"), read["is_ne"].alias("is_ne"))
        if stage in ("nedg", "pdg", "cdg"):
            return joined.select(key, F.when(text.isNull(), "failed").otherwise("text").alias("outcome"), parsing.description(text).alias("text"))
        read = {"ned1": parsing.ned1_option, "ned2": parsing.ned2_option, "pd": parsing.pd_option, "cd": parsing.pd_option}[stage](text)
        return joined.select(key, read["outcome"].alias("outcome"), candidates.pick(F.col("candidates"), read["choice"]).alias("picked"))

    def elicited(self, state: dict[str, DataFrame], answers: DataFrame, more: dict[str, DataFrame] | None = None) -> None:
        """New facts, and the entities they were asked of."""
        known = reuse.consistent_objects(state["triple"], self.limits.reuse_more_than)
        raw = parsing.facts(answers, "id", "text")
        start = next_number(state["triple"], "triple_id").first()[0]
        facts, classes = ingest(raw, known, start, num(F.col("subject_id")), F.col("place"))
        facts = staged(facts)
        classes = classes.alias("c").join(facts.select("triple_id"), F.col("original_triple_id") == F.col("triple_id"), "left_semi")
        failed = parsing.failed_facts(answers, "id", "text").withColumn("outcome", F.lit("failed"))
        explored = answers.select("id").join(failed, "id", "left_anti").withColumn("outcome", F.lit("explored"))
        delta = outcomes.apply_elicitation(state, explored.unionByName(failed))
        delta.inserts = {"triple": _filled(facts, "triple"), "instance_triple": _filled(classes, "instance_triple")}
        self.commit(delta, more)

    def commit(self, delta: Delta, more: dict[str, DataFrame] | None = None) -> None:
        """Apply a Delta, and write whole tables ``more`` with it; new entities, predicates and classes also get vectors of their labels."""
        for kind in ("entity", "predicate", "concept"):
            if kind in delta.inserts:
                rows = vectors.embed(delta.inserts[kind].select("embedding_index", "label"), "label", self.embedder)
                delta.inserts["vector"] = rows.select(F.lit(kind).alias("kind"), "embedding_index", "embedding")
        state = self.store.state()
        self.store.commit({n: delta.apply(n, state[n], KEYS[n][0]) for n in delta.tables} | (more or {}))


def _no_options() -> Column:
    """No candidates."""
    return F.array().cast("array<struct<position:int,id:string,label:string,description:string>>")


def _resolved(marked: DataFrame, name: str, key: str, **values: Column) -> Delta:
    kept = marked.filter(~F.col("is_duplicate"))
    return Delta(updates={name: [kept.select(key, *[v.alias(c) for c, v in values.items()])]}, deletes={name: marked.filter("is_duplicate").select(key)})


def _filled(df: DataFrame, name: str) -> DataFrame:
    """``df`` with all columns of a table; those it lacks are null, the time of creation is now."""
    have = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in have else (F.current_timestamp() if f.name == "created_at" else F.lit(None).cast(f.dataType)).alias(f.name) for f in TABLES[name]])
