"""Encoding and decoding through a vocabulary table.

A vocabulary of checked, bounded size is sent to the executors once and
applied to whole Arrow batches: encoding is then a narrow map, as it is in
nature, with no exploded tokens and no shuffle. With a larger vocabulary rows
go in blocks: the frequent tokens are still sent, and of the rare ones a block
joins each once, however many positions hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import PySparkTypeError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqprep.functions import arrays as A
from seqprep.functions.text import normalize, words
from seqprep.operators.guards import ENCODED_COLUMNS
from seqprep.operators.sampling import nth_largest
from seqprep.options import EOS_ID, PAD_ID, SPECIAL_TOKENS, UNK_ID, PrepOptions
from seqprep.session import remove_copies, shuffles_freed, write_shared

# A vocabulary is broadcast only when it is measured to be below both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

# Beyond them, so many of the most frequent elements of the column itself are
# still resolved that way; any other holds less than two in this many positions.
# Of an element longer than HOT_BYTES only a digest is sent.
HOT_ELEMENTS = 50_000
HOT_BYTES = 1_024

# A block is closed once it has so many elements or bytes. The larger it is, the
# fewer elements are sent for as many positions; a task holds one at a time.
BLOCK_ELEMENTS = 2 << 20
BLOCK_BYTES = 32 << 20
# What comes back of a block goes on in pieces of about so many bytes.
OUT_BYTES = 16 << 20


# --- pairs ----------------------------------------------------------------


def select_pair(
    df: DataFrame, source_lang: str = "fr", target_lang: str = "en", keep: Sequence[str] = ("id", "split")
) -> DataFrame:
    """Source and target text of a ``translation`` map or struct column."""
    kept = [c for c in keep if c in df.columns]
    pair = F.col("translation")
    return df.select(*kept, pair[source_lang].alias("source"), pair[target_lang].alias("target"))


# --- lookup of array elements in a two-column table -----------------------


def _fits(table: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Measure the table: is it small enough to send to every executor?"""
    size = table.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col("token"))), F.lit(0)).alias("bytes"),
    ).head()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def _element_key(element: Column) -> Column:
    """A string as it is, or its SHA-256 digest when it is long; the first letter tells which."""
    short = F.octet_length(element) <= HOT_BYTES
    return F.when(short, F.concat(F.lit("s"), element)).otherwise(F.concat(F.lit("l"), F.sha2(element.cast("binary"), 256)))


class Lookup:
    """A two-column table ready to be looked up in, for any number of data frames.

    It is measured once. A table below both bounds is collected and sent to the
    executors once; ``close`` frees it there. A larger one is joined. ``fits``
    tells what is known of the bounds already.
    """

    def __init__(
        self, table: DataFrame, probe: str, value: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES, fits: bool | None = None
    ):
        self.table, self.probe, self.value = table, probe, value
        self.element = table.schema[value].dataType
        self.fits = _fits(table, max_rows, max_bytes) if fits is None else fits
        self.sent = None
        if self.fits:
            entries = table.select(probe, value).toArrow()
            self.sent = _send(table.sparkSession, entries)

    def reversed(self) -> Lookup:
        """The same table looked up by its values; it isn't measured again."""
        return Lookup(self.table, self.value, self.probe, fits=self.fits)

    def close(self) -> None:
        """Free the executors' copies; frames made with the lookup can't be computed any more."""
        if self.sent is not None:
            self.sent.destroy()
            self.sent = None

    def __enter__(self) -> Lookup:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()


def vocab_lookup(vocab: DataFrame, **bounds: int) -> Lookup:
    """A vocabulary ready to encode any number of data frames."""
    return Lookup(vocab, "token", "token_id", **bounds)


def _send(spark: SparkSession, entries: pa.Table):
    """The values by element, as a worker reads them once for all its tasks, and their type."""
    elements, values = (column.to_pylist() for column in entries.columns)
    return spark.sparkContext.broadcast((dict(zip(elements, values, strict=True)), entries.schema.types[1]))


def _broadcast_lookup(sent, element: T.DataType, default: int | None):
    """A Column function that replaces each array element by its table value; ``sent`` holds the values by element."""

    @F.arrow_udf(T.ArrayType(element))
    def lookup(column: pa.Array) -> pa.Array:
        known, kind = sent.value
        # Each distinct element of the batch is looked up once.
        coded = column.flatten().dictionary_encode()
        found = pa.array([known.get(item) for item in coded.dictionary.to_pylist()], kind).take(coded.indices)
        if default is not None:  # for NULL elements as well
            found = pc.fill_null(found, default)
        lengths = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False)
        offsets, missing = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), column.is_null()
        return pa.ListArray.from_arrays(offsets, found, mask=missing)

    return lookup


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _blocks(df: DataFrame, keep: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """The rows in blocks, written once, so that a block keeps its rows whatever is recomputed.

    A block has a row for each of its distinct elements (``_code``, ``_element``
    and how many positions hold it, ``_n``), in falling order of that number, and
    one with the kept columns and the arrays' lengths (``_rows``) and the codes of
    its ``_n`` positions (``_codes``). Most codes are small, so their bytes are
    stored by significance, where they compress to about one and a half each.
    """
    kind = df.select(F.concat(*[_quoted(a) for a in arrays]).alias("a")).schema["a"].dataType
    kind = T.ArrayType(kind.elementType)
    columns = [_quoted(c).alias(f"k{i}") for i, c in enumerate(keep)]
    columns += [_quoted(a).cast(kind).alias(f"a{i}") for i, a in enumerate(arrays)]
    n_kept, most_elements, most_bytes = len(keep), BLOCK_ELEMENTS, BLOCK_BYTES
    schema = T.StructType().add("_block", "long").add("_code", "integer").add("_element", kind.elementType).add("_n", "long")
    schema = schema.add("_rows", "binary").add("_codes", "binary")

    def pack(batches):
        number = TaskContext.get().partitionId() << 33
        held, size, elements = [], 0, 0

        def block():
            rows = pa.Table.from_batches(held)
            lists = [rows.column(i).combine_chunks() for i in range(n_kept, rows.num_columns)]
            coded = pa.chunked_array([x.flatten() for x in lists]).dictionary_encode().combine_chunks()
            n = len(coded.dictionary)
            codes = pc.fill_null(coded.indices, n).to_numpy()  # n: a NULL element
            counts = np.bincount(codes, minlength=n + 1)[:n]
            order = np.argsort(-counts, kind="stable")
            places = np.append(np.empty(n, "<i4"), n).astype("<i4")
            places[order] = np.arange(n, dtype="<i4")
            planes = np.ascontiguousarray(places[codes].view(np.uint8).reshape(-1, 4).T)
            kept = pa.table([*rows.columns[:n_kept], *[x.value_lengths() for x in lists]], [f"c{i}" for i in range(rows.num_columns)])
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, kept.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(kept)
            packed = pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)
            for columns in (
                [pa.array(np.arange(n, dtype=np.int32)), coded.dictionary.take(pa.array(order)), pa.array(counts[order], pa.int64()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                [pa.nulls(1, pa.int32()), pa.nulls(1, coded.dictionary.type), pa.array([len(codes)], pa.int64()),
                 pa.array([out.getvalue().to_pybytes()], pa.binary()), pa.array([packed], pa.binary())],
            ):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), number, np.int64)), *columns], names)

        names = schema.names
        for batch in batches:
            lists = [batch.column(i) for i in range(n_kept, batch.num_columns)]
            ends = np.cumsum(sum(pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists))
            width, start = batch.nbytes / max(batch.num_rows, 1), 0
            while start < batch.num_rows:
                passed = ends[start - 1] if start else 0
                stop = int(np.searchsorted(ends, passed + most_elements - elements, "right"))
                stop = min(max(stop, start + 1), start + max(int((most_bytes - size) / max(width, 1)), 1), batch.num_rows)
                held.append(batch.slice(start, stop - start))
                size += int(width * (stop - start))
                elements += int(ends[stop - 1] - passed)
                start = stop
                if start < batch.num_rows or elements >= most_elements or size >= most_bytes:
                    yield from block()
                    number, held, size, elements = number + 1, [], 0, 0
        if sum(b.num_rows for b in held):
            yield from block()

    return write_shared(df.select(*columns).mapInArrow(pack, schema), "blocks", "zstd")


def _element_keyed(element: T.DataType):
    return _element_key if isinstance(element, T.StringType) else lambda column: column


def _hot_entries(elements: DataFrame, known: DataFrame, n: int) -> pa.Table:
    """Keys of at most ``n`` of the most frequent elements, with their value, if any.

    Only the ``n`` most frequent elements of each block are counted: what is in
    no block among them is a row of the join for each block at most. The
    frequency that at most ``n`` elements exceed is found by counting
    frequencies; no task sorts or holds the elements of others. The keys, no more
    than ``n``, are sent to the table, so that it isn't shuffled for them.
    """
    keyed = _element_keyed(elements.schema["_element"].dataType)
    often = elements.filter(F.col("_code") < n)
    counts = write_shared(often.groupBy(keyed(F.col("_element")).alias("_hot")).agg(F.sum("_n").alias("_n")), "element-counts")
    edge = nth_largest(counts, "_n", n + 1) if n else (float("inf"), 0)
    hot = counts.select("_hot") if edge is None else counts.filter(F.col("_n") > edge[0]).select("_hot")
    found = known.select(keyed(F.col("_known")).alias("_hot"), "_value").join(F.broadcast(hot), "_hot")
    with shuffles_freed(counts.sparkSession):
        entries = hot.join(found, "_hot", "left").toArrow()  # n rows at most
    remove_copies(counts)
    return entries


def _joined_lookup(
    df: DataFrame,
    arrays: dict[str, str],
    table: DataFrame,
    probe: str,
    value: str,
    default: int | None,
    hot_elements: int,
    keep: Sequence[str],
) -> DataFrame:
    """The same replacement for a table of any size.

    The rows are written once, in blocks, with each distinct element of a block
    beside them. The ``hot_elements`` most frequent elements (found by a count of
    each block's most frequent) are sent, whether the table has them or not; the
    others are joined, once for each block that has them - none is in so many
    that it skews the join. The values found meet the rows of their block, which go there as they
    are stored. No key is needed, and rows with equal or NULL keys stay apart.
    """
    spark, element = df.sparkSession, table.schema[value].dataType
    known = table.select(F.col(probe).alias("_known"), F.col(value).alias("_value"))
    blocks = _blocks(df, keep, list(arrays.values()))
    entries = blocks.filter("_code is not null")
    keyed = _element_keyed(blocks.schema["_element"].dataType)
    sent = _hot_entries(entries, known, hot_elements)
    key_type = entries.select(keyed(F.col("_element")).alias("_hot")).schema["_hot"].dataType
    hot = F.broadcast(spark.createDataFrame(sent, T.StructType().add("_hot", key_type).add("_value", element)))

    here = keyed(F.col("_element")) == F.col("_hot")
    often = entries.join(hot.filter("_value is not null"), here)
    # The table is hashed: an element is there once, so the entries, which are many more, needn't be sorted.
    rare = entries.join(hot, here, "left_anti").join(known.hint("shuffle_hash"), F.col("_element") == F.col("_known"))
    found = often.select("_block", "_code", "_value").unionByName(rare.select("_block", "_code", "_value"))
    found = write_shared(found, "found", "zstd")  # the join's shuffle files go before the rows travel
    rows = blocks.filter("_codes is not null").select("_block", "_n", "_rows", "_codes")
    both = found.unionByName(rows, allowMissingColumns=True)
    together = both.repartition("_block").sortWithinPartitions("_block", F.col("_codes").isNotNull())

    n_kept, kept = len(keep), [df.schema[c].dataType for c in keep]
    schema = T.StructType([T.StructField(f"k{i}", kind) for i, kind in enumerate(kept)])
    for i in range(len(arrays)):
        schema = schema.add(f"a{i}", T.ArrayType(element))
    most_bytes, most_rows, names = OUT_BYTES, 4_096, schema.names
    kind_is_text = isinstance(element, T.StringType)

    def unpack(batches):
        codes, values = [], []  # of the block that comes

        def block(places, found, n, rows, packed):
            planes = np.frombuffer(pa.Codec("zstd").decompress(packed, n * 4, asbytes=True), np.uint8).reshape(4, n)
            at = np.ascontiguousarray(planes.T).view("<i4").ravel()
            of_code = np.full(at.max() + 1 if n else 0, -1, np.int64)
            of_code[places] = np.arange(len(places))
            found = found.take(pa.array(of_code, mask=of_code < 0))
            if default is not None:  # for NULL elements as well
                found = pc.fill_null(found, default)
            kept = pa.ipc.open_stream(rows).read_all().combine_chunks()
            lengths = [pc.fill_null(c, 0).to_numpy().astype(np.int64) for c in kept.columns[n_kept:]]
            ends = np.cumsum(np.concatenate([[0], *lengths]))
            size = pc.fill_null(pc.binary_length(found), 0).to_numpy()[at] if kind_is_text else np.zeros(n, np.int64)
            size = np.concatenate([[0], np.cumsum(size + 8, dtype=np.int64)])[ends]
            m = kept.num_rows
            weight = np.cumsum(sum(np.diff(size[i * m : i * m + m + 1]) for i in range(len(lengths))))
            start = 0
            while start < m:
                stop = int(np.searchsorted(weight, (weight[start - 1] if start else 0) + most_bytes, "right"))
                stop = min(max(stop, start + 1), start + most_rows)
                some = kept.slice(start, stop - start)
                columns = [c.combine_chunks() for c in some.columns]
                for i in range(len(lengths)):
                    own = ends[i * m + start : i * m + stop + 1]
                    items = found.take(pa.array(at[own[0] : own[-1]]))
                    columns[n_kept + i] = pa.ListArray.from_arrays(pa.array(own - own[0], pa.int32()), items, mask=columns[n_kept + i].is_null())
                yield pa.RecordBatch.from_arrays(columns, names)
                start = stop

        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            start = 0
            for end in np.flatnonzero(column["_codes"].is_valid().to_numpy(zero_copy_only=False)).tolist():
                codes.append(column["_code"].slice(start, end - start))
                values.append(column["_value"].slice(start, end - start))
                places = np.concatenate([c.to_numpy() for c in codes])
                yield from block(
                    places, pa.concat_arrays(values), column["_n"][end].as_py(), column["_rows"][end].as_buffer(), column["_codes"][end].as_buffer()
                )
                codes.clear(), values.clear()
                start = end + 1
            codes.append(column["_code"].slice(start))
            values.append(column["_value"].slice(start))

    out = together.mapInArrow(unpack, schema)
    return out.toDF(*keep, *arrays)


def _arrow_takes(schema: T.StructType) -> bool:
    try:
        to_arrow_schema(schema)
    except PySparkTypeError:
        return False
    return True


def lookup_arrays(
    df: DataFrame,
    arrays: dict[str, str],
    table: DataFrame | Lookup,
    probe: str,
    value: str,
    default: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_elements: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Replace array elements by their value in a vocabulary table.

    ``arrays`` maps each new column to the array column it comes from.
    Elements that are not in the table become ``default``. The rows are the same
    on both sides of the bounds, whatever their keys. A ``Lookup`` in place of the
    table is not measured or sent again. The result has the columns ``keep`` of
    ``df``, all if it isn't given, and the new ones.
    """
    if not isinstance(table, Lookup):
        table = Lookup(table, probe, value, max_rows, max_bytes)
    if (table.probe, table.value) != (probe, value):
        raise ValueError(f"the lookup gives {table.value!r} for {table.probe!r}, not {value!r} for {probe!r}")
    kept = [c for c in df.columns if (keep is None or c in keep) and c not in arrays]
    wide = [c for c in df.columns if c in kept or c in arrays] + [c for c in arrays if c not in df.columns]
    if table.sent is not None:
        lookup = _broadcast_lookup(table.sent, table.element, default)
        found = df.withColumns({new: lookup(F.col(old)) for new, old in arrays.items()})
    else:
        tail = table.table, probe, value, default, HOT_ELEMENTS if hot_elements is None else hot_elements
        if _arrow_takes(df.select(*map(_quoted, kept)).schema):
            found = _joined_lookup(df, arrays, *tail, kept)
        else:  # what Arrow has no type for is brought back by a tag
            tagged = write_shared(df.withColumn("_row", F.monotonically_increasing_id()), "tagged")
            found = _joined_lookup(tagged, arrays, *tail, ["_row"])
            found = tagged.select("_row", *map(_quoted, kept)).join(found, "_row")
    return found.select(*map(_quoted, wide))


# --- encode ---------------------------------------------------------------


def encode(
    df: DataFrame,
    col: str,
    vocab: DataFrame | Lookup,
    out: str = "ids",
    max_len: int | None = None,
    add_special: bool = True,
    padding: str | None = None,
    keep: Sequence[str] | None = None,
    **bounds: int,
) -> DataFrame:
    """Token ids of a text column; unknown words get the ``<unk>`` id. The columns ``keep`` stay, or all."""
    return _encode(df, {out: (col, max_len)}, vocab, add_special, padding, df.columns if keep is None else keep, **bounds)


def _encode(
    df: DataFrame,
    columns: dict[str, tuple[str, int | None]],
    vocab: DataFrame | Lookup,
    add_special: bool,
    padding: str | None,
    keep: Sequence[str],
    **bounds: int,
) -> DataFrame:
    split = {}
    for out, (col, max_len) in columns.items():
        # One word is one id, so cutting the words first is the same cut.
        room = None if max_len is None else max_len - (1 if add_special else 0)
        found = words(F.col(col))
        split[f"_{out}"] = found if room is None else F.slice(found, 1, room)
    ready = df.withColumns(split)
    ready = lookup_arrays(
        ready, {out: f"_{out}" for out in columns}, vocab, "token", "token_id", UNK_ID, keep=keep, **bounds
    )
    ids = {}
    for out, (_, max_len) in columns.items():
        column = A.append_eos(F.col(out), EOS_ID) if add_special else F.col(out)
        if padding == "max_length" and max_len is not None:
            column = A.pad_to(column, max_len, PAD_ID)
        ids[out] = column
    return ready.withColumns(ids)


def encode_pairs(
    df: DataFrame,
    vocab: DataFrame | Lookup,
    opts: PrepOptions = PrepOptions(),
    key: str | Sequence[str] = "id",
    keep: Sequence[str] = ("split",),
    **bounds: int,
) -> DataFrame:
    """``source`` and ``target`` text to ``input_ids``, ``attention_mask``, ``labels``.

    With ``opts.padding=None`` the sequences keep their own length.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = keys + [c for c in keep if c in df.columns and c not in keys]
    texts = {c: normalize(F.col(c)) if opts.normalize else F.col(c) for c in ("source", "target")}
    pairs = df.select(*kept, *[text.alias(c) for c, text in texts.items()])
    columns = {"_src": ("source", opts.max_source_length), "labels": ("target", opts.max_target_length)}
    encoded = _encode(pairs, columns, vocab, True, None, kept, **bounds)
    src, labels = F.col("_src"), F.col("labels")
    if opts.padding == "max_length":
        mask = A.attention_mask(src, opts.max_source_length)
        padded = A.pad_to(src, opts.max_source_length), mask, A.pad_to(labels, opts.max_target_length)
    else:
        padded = src, A.attention_mask(src), labels
    return encoded.select(*kept, *[c.alias(n) for n, c in zip(ENCODED_COLUMNS, padded, strict=True)])


# --- decode ---------------------------------------------------------------


def decode(
    df: DataFrame,
    cols: str | dict[str, str],
    vocab: DataFrame | Lookup,
    out: str = "text",
    skip_special: bool = True,
    keep: Sequence[str] | None = None,
    **bounds: int,
) -> DataFrame:
    """Text of an id column, or of several (``{new column: id column}``). The columns ``keep`` stay, or all.

    Ids that are not in the vocabulary leave no trace; with ``skip_special``
    neither do special ids, ``<unk>`` included.
    """
    keep = df.columns if keep is None else keep
    columns = {out: cols} if isinstance(cols, str) else dict(cols)
    ids = {
        f"_{new}": F.filter(old, lambda x: x >= len(SPECIAL_TOKENS)) if skip_special else F.col(old)
        for new, old in columns.items()
    }
    found = lookup_arrays(
        df.withColumns(ids), {new: f"_{new}" for new in columns}, vocab, "token_id", "token", None, keep=keep, **bounds
    )
    return found.withColumns({new: F.array_join(new, " ") for new in columns})


def token_labels(
    df: DataFrame, col: str, vocab: DataFrame | Lookup, key: str | Sequence[str] = "id", **bounds: int
) -> DataFrame:
    """One row per position: the id there and its token."""
    keys = [key] if isinstance(key, str) else list(key)
    found = lookup_arrays(
        df.select(*keys, col), {"_tokens": col}, vocab, "token_id", "token", None, **bounds
    )
    pairs = F.arrays_zip(F.col(col).alias("token_id"), F.col("_tokens").alias("token"))
    return found.select(*keys, F.posexplode(pairs).alias("pos", "_p")).select(
        *keys, "pos", F.col("_p.token_id").alias("token_id"), F.col("_p.token").alias("token")
    )
