"""Parallel corpora: reading, pairing, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import MapType, StructType

# Reader options of the text formats.
_FORMATS = {
    "parquet": ("parquet", {}),
    "orc": ("orc", {}),
    "json": ("json", {}),
    "csv": ("csv", {"header": "true", "escape": '"'}),
    "tsv": ("csv", {"header": "true", "sep": "\t", "quote": ""}),
}


def read_parallel(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str | StructType | None = None,
    id_col: str = "id",
    languages: Mapping[str, str] | None = None,
    multi_line: bool = False,
    files: Sequence[str] | None = None,
    file_key: bool = False,
) -> DataFrame:
    """Sentence pairs as ``id, [split,] translation``.

    A folder written with ``split=...`` sub-folders gets its ``split`` column
    from them, so a filter on it prunes whole folders. ``languages`` packs flat
    text columns (``{language code: column}``) into the ``translation`` struct;
    without it the data must already have that column (struct or map).

    Data without an id column get ids that a later read gives again and that no
    two rows share, in whatever split folder they are: Parquet rows the full path
    of their file and their place in it, rows of other formats their contents'
    hash and number among the rows with the same contents (``content_ids``). Ids
    of text formats become numbers when all of a value is digits and ``schema``
    does not say otherwise. ``multi_line`` reads CSV fields with line breaks; such
    a file is one task.

    ``files`` reads only these files below ``path``; ``file_key`` adds the column
    ``file``, a hash of the file's path, size and time.
    """
    if fmt not in _FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {sorted(_FORMATS)}")
    name, options = _FORMATS[fmt]
    if multi_line:
        options = {**options, "multiLine": "true"}
    reader = spark.read.format(name).options(**options)
    if files is not None:
        reader = reader.option("basePath", path)
    df = (reader.schema(schema) if schema is not None else reader).load(path if files is None else list(files))
    if languages:
        pair = F.struct(*[F.col(c).alias(lang) for lang, c in languages.items()])
        df = df.withColumn("translation", pair)
    if "translation" not in df.columns:
        raise ValueError(f"no translation column in {path}; found {df.columns}")
    kept = (["split"] if "split" in df.columns else []) + ["translation"]
    origin = [key_of_file().alias("file")] if file_key else []
    if id_col not in df.columns:
        if fmt == "parquet":
            place = F.concat_ws(":", "_metadata.file_path", "_metadata.row_index")
            return df.select(place.alias("id"), *kept, *origin)
        if files is not None:
            raise ValueError(f"no id column {id_col!r} in {path}: ids from contents need all files")
        return content_ids(df, kept, origin)
    number = F.col(id_col)
    if schema is None and fmt in ("csv", "tsv") and df.filter(number.isNotNull() & number.try_cast("long").isNull()).isEmpty():
        number = number.cast("long")
    return df.select(number.alias("id"), *kept, *origin)


# --- ids and files ----------------------------------------------------------


def key_of_file() -> Column:
    """A hash of the path, size and time of the file a row comes from."""
    parts = ("_metadata.file_path", "_metadata.file_size", F.unix_micros("_metadata.file_modification_time"))
    return F.md5(F.concat_ws("|", *parts))


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` as ``file, path, size, modified``; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    details = [F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified")]
    return found.select(key_of_file().alias("file"), F.col("path"), *details)


def _with_length(text: Column) -> Column:
    text = text.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def content_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The split and the texts by language code as one text; no two contents give the same one."""
    parts = []
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, MapType):
            entries = F.array_sort(F.map_entries(name))
            parts.append(F.array_join(F.transform(entries, lambda e: F.concat(_with_length(e["key"]), _with_length(e["value"]))), ""))
        elif isinstance(kind, StructType):
            parts += [F.concat(_with_length(F.lit(lang)), _with_length(F.col(name)[lang])) for lang in sorted(kind.names)]
        else:
            parts.append(_with_length(F.col(name)))
    return F.concat(*[F.coalesce(p, F.lit("-")) for p in parts])


def content_ids(df: DataFrame, columns: Sequence[str], origin: Sequence[Column] = ()) -> DataFrame:
    """``id`` and the columns: the id is the contents' hash and the number of the row among its equals.

    Rows are numbered per block of a file, and the blocks' counts are summed up
    apart, so contents that make up a third of the rows are spread over as many
    groups as they have blocks. One shuffle of the rows.
    """
    block = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    rows = df.select(*columns, *origin, F.md5(content_text(df, columns)).alias("_hash"), *[c.alias(n) for n, c in block.items()])
    own = ["_hash", *block]
    earlier = Window.partitionBy("_hash").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*own).agg(F.count("*").alias("_n"))
    offsets = counts.select(*own, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    split = [c for c in columns if c == "split"]  # a filter on it passes the window
    place = F.row_number().over(Window.partitionBy(*split, *own).orderBy(F.lit(0))) - 1
    numbered = rows.withColumn("_place", place).join(offsets, own)
    number = (F.col("_before") + F.col("_place")).cast("string")
    return numbered.select(F.concat("_hash", F.lit(":"), number).alias("id"), *columns, *(["file"] if origin else []))


#: Turns of a conversation that fit below the next conversation's ids.
TURNS = 1 << 32


def pairs_from_turns(conv: DataFrame, source_lang: str = "fr", target_lang: str = "en") -> DataFrame:
    """Each user turn with the assistant turn right after it, as a pair.

    Joined on (conversation, turn), which is unique, so a huge conversation
    spreads over all tasks. The id is unique for any number of turns; a
    conversation id beyond 31 bits is an arithmetic error, not a wrong id.
    """
    asked = conv.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("_source"))
    answered = conv.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_target")
    )
    bucket = F.col("conv_id") % 10
    split = F.when(bucket == 0, "validation").when(bucket == 1, "test").otherwise("train")
    return asked.join(answered, ["conv_id", "turn"]).select(
        (F.col("conv_id") * TURNS + F.col("turn")).alias("id"),
        split.alias("split"),
        F.struct(F.col("_source").alias(source_lang), F.col("_target").alias(target_lang)).alias("translation"),
    )


def eval_split_name(df: DataFrame) -> str:
    """``validation`` when the data has it, else ``test``; an error when it has neither."""
    for name in ("validation", "test"):
        if not df.filter(F.col("split") == name).isEmpty():
            return name
    raise ValueError("the data has neither a validation nor a test split")


def resolve_eval_split(df: DataFrame) -> DataFrame:
    """The rows of the evaluation split."""
    return df.filter(F.col("split") == eval_split_name(df))


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split."""
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))
