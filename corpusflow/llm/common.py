"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: the white space that ends a word, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only on a local master that sets none."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="corpusflow-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor rereads files instead of recomputing) and
    gives later joins real sizes, so that the planner broadcasts only what it
    has measured.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def beside(stage):
    """A stage ``docs -> docs`` that sees the columns of ``DOCUMENT`` only; others travel in one struct under a fresh name.

    So whatever the others are called, they cannot clash with the stage's own
    columns, and come back unchanged and in place.
    """

    @functools.wraps(stage)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        if not others:
            return stage(docs, *args, **options)
        name, quoted = f"others_{uuid.uuid4().hex}", {c: F.col(f"`{c}`") for c in docs.columns}
        out = stage(docs.select(*[quoted[c] for c in docs.columns if c in DOCUMENT], F.struct(*[quoted[c] for c in others]).alias(name)), *args, **options)
        return out.select(*[F.col(c) if c in DOCUMENT else F.col(name)[c].alias(c) for c in docs.columns])

    return run


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of the same value; the second is seeded by the first."""
    first = F.xxhash64(*cols)
    return first, F.xxhash64(first, *cols)


def offsets(df: DataFrame, group: list[str], part: str) -> DataFrame:
    """Rows per (group, part), and how many rows of the group lie in smaller parts (column ``before``).

    Only the counts are windowed: a group has at most as many of them as it has
    parts, however many rows it holds.
    """
    counts = df.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__rows"))
    up_to = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("__rows").over(up_to), F.lit(0)))


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, parts: int = 256) -> DataFrame:
    """Gapless numbers from 0 within each group, as column ``out``.

    A group of any size is spread over ``parts`` hash parts of its ``order``
    columns; each part numbers its own rows and starts where the parts before
    it end.  ``df`` is read twice, so pass a stored table.
    """
    df = df.withColumn("__part", F.pmod(F.xxhash64(F.lit(7), *order), F.lit(parts)).cast("int"))
    starts = stored(offsets(df, group, "__part"), "offsets").drop("__rows")
    own = df.withColumn("__n", F.row_number().over(Window.partitionBy(*group, "__part").orderBy(*order)))
    starts = starts.select(*[F.col(c).alias(f"__o_{c}") for c in group], F.col("__part").alias("__o_part"), "before")
    same = F.col("__part") == F.col("__o_part")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    return (own.join(starts, same)
            .withColumn(out, (F.col("__n") - 1 + F.col("before")).cast("long"))
            .drop("__n", "__part", "__o_part", "before", *[f"__o_{c}" for c in group]))


def block_pairs(blocks: str = "blocks", own: str = "own") -> Column:
    """The pairs of blocks (i <= j) that a row of block ``own`` takes part in, as an array of structs.

    A group of one block is its own pair (0, 0).  In a group of more, every two
    rows meet in some pair (i < j), which holds the rows of both blocks.
    """
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    others = F.filter(F.sequence(F.lit(0), F.col(blocks) - 1), lambda k: k != F.col(own))
    return F.when(F.col(blocks) == 1, one).otherwise(
        F.transform(others, lambda k: F.struct(F.least(F.col(own), k).alias("i"), F.greatest(F.col(own), k).alias("j"))))


_HELD: dict[str, object] = {}


def worker_cache(owner: str, make):
    """What a worker keeps for an operator between its tasks; a worker that goes on to another operator drops it."""
    if owner not in _HELD:
        _HELD.clear()
        _HELD[owner] = make()
    return _HELD[owner]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, so that their workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="corpusflow-code-")).resolve() / "corpusflow-code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "corpusflow").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
