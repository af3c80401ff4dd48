"""Queries of the training-data problems, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import format_copies, heavy_hitters, leakage, names, neighbours, tokenize, truncation
from factloom.runtime import table


def _records(spark: SparkSession, root: str) -> DataFrame:
    """Facts and class facts as records of problem 3."""
    triple, classes = table(spark, root, "triple"), table(spark, root, "instance_triple")
    facts = triple.select(
        F.lit("predicate_label").alias("field_name"), F.col("subject_id").alias("subject"), F.col("object_label").alias("object"),
        format_copies.canonical(F.col("predicate_label")).alias("form"), format_copies.number(F.col("triple_id")).alias("num"),
    )
    typed = classes.select(
        F.lit("concept_label").alias("field_name"), F.col("entity_id").alias("subject"), F.lit("").alias("object"),
        format_copies.canonical(F.col("concept_label")).alias("form"), format_copies.number(F.col("original_triple_id")).alias("num"),
    )
    return facts.unionByName(typed)


KEYS = ["field_name", "subject", "object", "form"]


def _labels(spark: SparkSession, root: str) -> DataFrame:
    """Labels, and whether they are typed as names."""
    objects = table(spark, root, "triple").select(F.col("object_label").alias("label"), (F.col("object_type") == "ne").alias("typed"))
    return table(spark, root, "entity").select("label", F.lit(True).alias("typed")).unionByName(objects)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of spellings of one person or organisation."""
    return names.same_names(_labels(spark, root))


def p2_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Each spelling of a person or organisation with its cluster and the number of spellings there."""
    found = names.clusters(_labels(spark, root)).select("label", "centre")
    sizes = found.groupBy("centre").agg(F.count("*").alias("spellings"))
    return found.join(sizes, "centre").select("label", "centre", "spellings")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Each further id of a fact that is stored under several ids."""
    return format_copies.runs(_records(spark, root), KEYS, "num", singles=False).filter("copy_num > first_num").select("field_name", "first_num", "copy_num")


def p3_collapsed(spark: SparkSession, root: str) -> DataFrame:
    """One record per fact with its number of copies."""
    return format_copies.collapse(_records(spark, root), KEYS, "num").select("field_name", "first_num", "copies")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """The ten most frequent predicate and object labels."""
    top = heavy_hitters.most_frequent(table(spark, root, "triple"), ["predicate_label", "object_label"], 10)
    return top.select(F.col("field").alias("field_name"), F.col("value").alias("label"))


def p4_counts(spark: SparkSession, root: str) -> DataFrame:
    """The ten most frequent labels with their exact counts."""
    top = heavy_hitters.most_frequent(table(spark, root, "triple"), ["predicate_label", "object_label"], 10)
    return top.select(F.col("field").alias("field_name"), F.col("value").alias("label"), F.col("count").alias("n"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of indexes of similar vectors."""
    return neighbours.similar_pairs(table(spark, root, "label_vector"))


def p5_neighbours(spark: SparkSession, root: str) -> DataFrame:
    """The five most similar vectors, however similar, of every hundredth index."""
    found = neighbours.similar(table(spark, root, "label_vector"), 5, every=100)
    return found.select("kind", "index", "neighbour", "rank")


def p6_ids(spark: SparkSession, root: str) -> DataFrame:
    """Token ids of each document."""
    return tokenize.encode(table(spark, root, "documents"))


def p6_decoded(spark: SparkSession, root: str) -> DataFrame:
    """Each document's text after encoding and decoding."""
    return tokenize.decode(tokenize.encode(table(spark, root, "documents")))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents with the items they leak."""
    return leakage.hits(table(spark, root, "documents"), table(spark, root, "eval_items")).select("doc_id", "item_id").distinct()


def p7_covered(spark: SparkSession, root: str) -> DataFrame:
    """Documents with the items they leak and the number of the item's words they hold."""
    return leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that were cut."""
    return truncation.truncated(table(spark, root, "documents")).filter("cut").select("doc_id").distinct()


def p8_rates(spark: SparkSession, root: str) -> DataFrame:
    """How often each source cuts."""
    return truncation.rates(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_clusters": p2_clusters,
    "p3_found": p3_found,
    "p3_collapsed": p3_collapsed,
    "p4_found": p4_found,
    "p4_counts": p4_counts,
    "p5_found": p5_found,
    "p5_neighbours": p5_neighbours,
    "p6_ids": p6_ids,
    "p6_decoded": p6_decoded,
    "p7_found": p7_found,
    "p7_covered": p7_covered,
    "p8_found": p8_found,
    "p8_rates": p8_rates,
}

_NOISE_SQL = r"[\s\pZ\pC\pP$+<=>^`|~]+"
_FORM_SQL = f"array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array(lower({{0}}), '[,;/|]'), lambda p: regexp_replace(p, '{_NOISE_SQL}', '', 'g')), lambda p: p <> '')), chr(1))"


def _form(c: str) -> str:
    form = _FORM_SQL.format(c)
    return f"CASE WHEN {form} = '' THEN chr(2) || regexp_replace({c}, '[\\s\\pZ\\pC]+', '', 'g') ELSE {form} END"


_RECORDS_SQL = f"""
    SELECT DISTINCT 'predicate_label' AS field_name, subject_id AS subject, object_label AS object, {_form("predicate_label")} AS form,
           TRY_CAST(regexp_replace(triple_id, '\\D', '', 'g') AS BIGINT) AS num FROM triple
    UNION ALL
    SELECT DISTINCT 'concept_label', entity_id, '', {_form("concept_label")}, TRY_CAST(regexp_replace(original_triple_id, '\\D', '', 'g') AS BIGINT) FROM instance_triple"""
_WHOLE_SQL = f"SELECT * FROM ({_RECORDS_SQL}) WHERE subject IS NOT NULL AND object IS NOT NULL AND form IS NOT NULL AND num IS NOT NULL"
_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS field_name, {c} AS label, count(*) AS n FROM triple WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, label LIMIT 10)" for c in ("predicate_label", "object_label")
)

_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_GRAMS_SQL = "SELECT DISTINCT {0}, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k+11], ' '))) AS g FROM {1} WHERE len(w) >= 12"
_LEAKS_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {_WORDS_SQL} AS w FROM eval_items WHERE text IS NOT NULL)
    SELECT DISTINCT doc_id, item_id FROM ({_GRAMS_SQL.format("doc_id", "d")}) JOIN ({_GRAMS_SQL.format("item_id", "i")}) USING (g)
    UNION SELECT doc_id, item_id FROM d JOIN i ON len(i.w) BETWEEN 1 AND 11 AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(i.w, ' ') || ' ')"""
_UNITS_SQL = "(SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM (SELECT kind, embedding_index AS idx, min(embedding)::DOUBLE[] AS v FROM label_vector GROUP BY 1, 2) WHERE list_dot_product(v, v) > 0)"
_NEAR_SQL = f"""SELECT kind, index, neighbour, CAST(row_number() OVER (PARTITION BY kind, index ORDER BY round(s, 7) DESC, neighbour) AS INTEGER) AS rank, s
    FROM (SELECT a.kind, a.idx AS index, b.idx AS neighbour, list_dot_product(a.v, b.v) / (a.norm * b.norm) AS s FROM {_UNITS_SQL} a JOIN {_UNITS_SQL} b ON a.kind = b.kind AND a.idx <> b.idx)"""

ORACLE: dict[str, str] = {
    "p3_found": f"""SELECT field_name, first_num, num AS copy_num FROM (SELECT field_name, num, min(num) OVER (PARTITION BY field_name, subject, object, form) AS first_num FROM ({_WHOLE_SQL})) WHERE num > first_num""",
    "p3_collapsed": f"SELECT field_name, min(num) AS first_num, count(*) AS copies FROM ({_WHOLE_SQL}) GROUP BY field_name, subject, object, form",
    "p4_found": f"SELECT field_name, label FROM ({_COUNTS_SQL})",
    "p4_counts": _COUNTS_SQL,
    "p5_found": f"SELECT DISTINCT kind, least(index, neighbour) AS index_a, greatest(index, neighbour) AS index_b FROM ({_NEAR_SQL}) WHERE rank <= 5 AND s >= 0.85",
    "p5_neighbours": f"SELECT kind, index, neighbour, rank FROM ({_NEAR_SQL}) WHERE rank <= 5 AND index % 100 = 0",
    "p7_found": _LEAKS_SQL,
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of this subpackage by name."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those queries that SQL can express."""
    return dict(ORACLE)
