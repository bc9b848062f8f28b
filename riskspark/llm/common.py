"""Helpers shared by the text operators: reading, scratch tables, per-text Arrow maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import scratch_path

# ASCII bytes outside a-z, A-Z and 0-9 become a space, A-Z become a-z; bytes of other
# characters stay. ``split`` then yields the lower-cased words of a text.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
CONTINUATION = bytes(range(0x80, 0xC0))
BLANKS = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The written table cuts the lineage and survives lost executors. It goes when the
    Spark application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.translate(WORD_TABLE).split()


def code_points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))


def slices(texts: Sequence[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) ranges of about ``limit`` bytes; a longer text is alone in its range."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def map_texts(df: DataFrame, make: Callable, fields: Sequence[T.StructField], text: str = "text",
              keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``fields``, computed from the texts alone, to the columns ``keep``.

    ``make()`` runs once a task and returns ``f(texts) -> {name: list}`` with the lists in the order
    of ``fields``; ``texts`` is a list of UTF-8 bytes (a null text is empty). Rows keep their order and number.
    """
    keep = list(df.columns) if keep is None else list(keep)
    carried = text in keep
    sel = [F.col(f"`{c}`") for c in keep] + ([] if carried else [F.col(f"`{text}`").cast("string").alias("__text")])
    src = df.select(*sel)
    at = keep.index(text) if carried else len(keep)
    schema = T.StructType([*src.schema.fields[: len(keep)], *fields])
    names = [f.name for f in fields]
    n_keep = len(keep)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        f = make()
        for batch in batches:
            raw = [b or b"" for b in batch.column(at).cast(pa.binary()).to_pylist()]
            out: dict[str, list] = {n: [] for n in names}
            for lo, hi in slices(raw):
                for n, v in zip(names, f(raw[lo:hi]).values()):
                    out[n].extend(v)
            cols = [batch.column(i) for i in range(n_keep)]
            cols += [pa.array(out[n], type=t) for n, t in zip(names, types)]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:n_keep], *names])

    return src.mapInArrow(run, schema)


def with_safe_names(docs: DataFrame, f: Callable) -> DataFrame:
    """``f(d, at)`` under the column names of ``docs``: ``d`` holds the same columns as c0, c1, ..., which no helper
    column is called, ``at(name)`` is the new name of a column, and ``f`` returns the columns in their order."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    places = {c.lower(): n for c, n in zip(docs.columns, names)}
    return f(docs.toDF(*names), lambda c: places[c.lower()]).toDF(*docs.columns)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
