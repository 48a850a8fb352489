"""Text to ids and back, as joins with the vocabulary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.tokens import text_lengths
from tokenloom.operators import blocks
from tokenloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, head_of, lookup, range_lookup
from tokenloom.operators.vocab import token_id

UNK = "<unk>"
RANGE = "range"


def token_lengths(df: DataFrame, text: str = "text", specials: Sequence[str] = ()) -> DataFrame:
    """Add ``n``, the number of tokens, straight from the text (no vocabulary needed)."""
    return df.withColumn("n", text_lengths(text, specials))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    key: Sequence[str],
    text: str = "text",
    specials: Sequence[str] = (),
    keep: Sequence[str] = (),
    unk: str = UNK,
    out: str = "input_ids",
    small: bool | None = None,
    unk_id: int | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(key, keep, out)``: the ids of each text; a token without an id gets that of ``unk``.

    The rows of one ``key`` count as one, their ids by position and then id.  Texts are not moved: see :mod:`blocks`.  A vocabulary of
    at most ``limit`` bytes is broadcast, a larger one is joined with the distinct tokens of blocks of rows; with a
    ``limit`` below one row nothing is broadcast, see :func:`encode_in_ranges`.
    ``small`` and ``unk_id`` save looking them up again.  Runs jobs: the numbered tokens are staged.
    """
    columns = [*key, *keep]
    table = vocab.select("token", F.col("id").alias("token_id"))
    unk_id = token_id(vocab, unk) if unk_id is None else unk_id
    if small is None:
        small = fits_broadcast(table, limit)
    if not small and head_of(table, "token_id", limit) is None:
        ids, repeated = encode_in_ranges(df, table, columns, text, specials, unk_id, out)
        return blocks.merged(ids, columns, out) if repeated else ids
    rows, known = numbered_texts(df, table, columns, text, specials, unk_id, small)
    ids = blocks.exchanged(rows, known, columns, out)
    return blocks.merged(ids, columns, out) if blocks.keys_repeat(rows, columns) else ids


def numbered_texts(
    df: DataFrame, table: DataFrame, columns: Sequence[str], text: str, specials: Sequence[str], unk_id: int, small: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows with numbers for their tokens, and the id of each number, from a table of ``token`` and ``token_id`` (see :mod:`blocks`)."""
    number = blocks.numbered_tokens(specials)
    rows, keys = blocks.numbered(df, columns, text, number, blocks.keys_of_texts, T.StringType())
    named = keys.withColumnRenamed("key", "token").join(F.broadcast(table) if small else table, "token", "left")
    return rows, named.select(blocks.BLOCK, blocks.CODE, F.coalesce("token_id", F.lit(unk_id)).alias(blocks.VALUE))


def encode_in_ranges(
    df: DataFrame, table: DataFrame, columns: Sequence[str], text: str, specials: Sequence[str], unk_id: int, out: str
) -> tuple[DataFrame, bool]:
    """``(columns, out)``, the ids of each text, with nothing broadcast, and whether two rows have equal columns.

    A range is some blocks of texts (see :mod:`blocks`).  The numbered texts and the distinct tokens of their blocks are shuffled once, and
    tokens not at all, see :func:`range_lookup`; ids are put in where that leaves them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = blocks.numbered_tokens(specials)
    staged = blocks.numbered_rows(df, columns, text, number, blocks.keys_of_texts, T.StringType())
    placed = staged.withColumn(RANGE, F.pmod(F.xxhash64(blocks.BLOCK), F.lit(parts)).cast("int"))
    named = range_lookup(placed, blocks.each_key("token"), table, "token", "token_id", RANGE, lambda d: d.repartition(parts, RANGE))
    every = named.withColumn(blocks.VALUE, F.coalesce("token_id", F.lit(unk_id)))
    rows = staged.filter(F.col(blocks.CODES).isNotNull())
    return blocks.exchanged_in_place(every, columns, out), blocks.keys_repeat(rows, columns)


def decode_tokens(
    df: DataFrame, vocab: DataFrame, key: Sequence[str], ids: str = "input_ids", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(key, pos, token_id, token)``: one row per id."""
    table = vocab.select(F.col("id").alias("token_id"), "token")
    if fits_broadcast(table, limit):
        rows = df.select(*key, F.posexplode_outer(ids).alias("pos", "token_id")).filter("pos IS NOT NULL")
        return lookup(rows, table, "token_id", True).select(*key, "pos", "token_id", "token")
    # The id goes with its token: one lookup gives both.
    pair = F.struct(F.col("key").alias("token_id"), "token")
    rows, keys = blocks.numbered(df, key, ids, blocks.numbered_ids, blocks.keys_of_lists, T.IntegerType())
    named = keys.join(table, F.col("key") == F.col("token_id"), "left").select(blocks.BLOCK, blocks.CODE, pair.alias(blocks.VALUE))
    tokens = blocks.exchanged(rows, named, key, "tokens").select(*key, F.posexplode("tokens").alias("pos", "t"))
    return tokens.select(*key, "pos", "t.token_id", "t.token")


def decode(
    df: DataFrame,
    vocab: DataFrame,
    key: Sequence[str],
    ids: str = "input_ids",
    skip_special: bool = False,
    out: str = "text",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(key, out)``: the text of each id sequence.  Vocabularies over ``limit`` bytes are not broadcast; see :mod:`blocks`."""
    table = vocab.select(F.col("id").alias("token_id"), "token", "special")
    small = fits_broadcast(table, limit)
    token = F.when(~F.col("special"), F.col("token")) if skip_special else F.col("token")
    rows, keys = blocks.numbered(df, key, ids, blocks.numbered_ids, blocks.keys_of_lists, T.IntegerType())
    named = keys.withColumnRenamed("key", "token_id").join(F.broadcast(table) if small else table, "token_id", "left")
    known = named.select(blocks.BLOCK, blocks.CODE, token.alias(blocks.VALUE))
    if not blocks.keys_repeat(rows, key):
        return blocks.exchanged(rows, known, key, out, together=True)
    tokens = blocks.merged(blocks.exchanged(rows, known, key, out), key, out)
    return tokens.withColumn(out, F.array_join(out, ""))
