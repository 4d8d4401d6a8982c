"""A corpus pipeline over documents: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.llm.common import WORD, documents, keep, small, text_of
from daystrata.llm.decontaminate import find_leaks
from daystrata.llm.exact_dedup import exact_dedup
from daystrata.llm.mixing import mix_sources
from daystrata.llm.near_dedup import near_duplicates
from daystrata.llm.toxicity import without_toxic

# Lists of rows to drop or keep that are broadcast; longer ones are joined by shuffle.
LISTED_ROWS = 200_000


def _names(docs: DataFrame, *wanted: str) -> list[str]:
    """Helper column names that no column of ``docs`` has, in either case of letters."""
    taken = {name.lower() for name in docs.columns}
    mark = "_"
    while any(mark + name in taken for name in wanted):
        mark += "_"
    return [mark + name for name in wanted]


def _met(columns: dict[str, Column | str]) -> Column:
    """Whether columns of a list are the same as columns or expressions of the documents, null as null."""
    result = F.lit(True)
    for listed, own in columns.items():
        result &= F.col(listed).eqNullSafe(own if isinstance(own, Column) else F.col(own))
    return result


def _order_of(docs: DataFrame) -> Column:
    """All columns as one value that can be ordered; those that cannot stand as JSON."""
    plain = lambda f: not any(t in f.dataType.simpleString() for t in ("map<", "variant", "interval"))
    return F.struct(*[F.col(f"`{f.name}`") if plain(f) else F.to_json(F.struct(f"`{f.name}`")) for f in docs.schema])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored as toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, one row stays: of those with the largest id, the least by all columns.

    Rows whose texts and ids are both equal, or both without id, are rare; only those are aggregated with their texts.
    """
    own_id, sha, row = _names(docs, "id", "sha256", "row")
    repeated = exact_dedup(docs).filter("group_size > 1")
    repeated = keep(repeated.select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(sha), "kept"))
    met = _met({own_id: "doc_id", sha: F.sha2(text_of(), 256)})
    rest = docs.join(small(repeated.filter(~F.col("kept")).drop("kept"), LISTED_ROWS), met, "left_anti")
    tied = keep(repeated.filter("kept").groupBy(own_id, sha).count().filter("count > 1").drop("count"))
    if tied.isEmpty():
        return rest
    tied = small(tied, LISTED_ROWS)
    every = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    least = rest.join(tied, met).groupBy(own_id, sha).agg(F.min_by(every, _order_of(docs)).alias(row))
    return rest.join(tied, met, "left_anti").unionByName(least.select(f"{row}.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, directly or over others, the one with the smallest id stays."""
    (own_id,) = _names(docs, "id")
    copies = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias(own_id))
    return docs.join(small(keep(copies), LISTED_ROWS), _met({own_id: "doc_id"}), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark, whether or not the item has an id."""
    own_id, hashed = _names(docs, "id", "hash")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = find_leaks(docs, benchmark.withColumn("item_id", F.coalesce(F.col("item_id").cast("long"), F.xxhash64("text"))))
    leaks = leaks.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(hashed)).distinct()
    return docs.join(small(keep(leaks), LISTED_ROWS), _met({own_id: "doc_id", hashed: F.xxhash64(text_of())}), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of times (mix_copies, in the place of a column of that name).

    Rows are numbered, so that of rows that are equal each is taken as often as the mix says.
    """
    number, copies = _names(docs, "number", "copies")
    numbered = keep(docs.withColumn(number, F.monotonically_increasing_id()))
    taken = mix_sources(numbered, carry=[number]).filter("copies > 0")
    (met,) = _names(numbered, "met")
    taken = small(keep(taken.select(F.col(number).alias(met), F.col("copies").alias(copies))), LISTED_ROWS)
    found = numbered.join(taken, F.col(number) == F.col(met)).withColumn("mix_copies", F.col(copies))
    return found.drop(number, met, copies)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]
# Tokens, seeds and a fitted model have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
