"""The vocabulary as a table ``(id INT, token STRING, special BOOLEAN)``, and its edits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.hashing import normal_hash
from tokenloom.functions.tokens import token_arrays
from tokenloom.operators.ordering import key_ranges, running_total
from tokenloom.staging import spread, stage

COUNTED_BYTES = 24 << 20
VOCAB_SCHEMA = "id INT, token STRING, special BOOLEAN"


def token_counts(df: DataFrame, text: str = "text", specials: Sequence[str] = ()) -> DataFrame:
    """``(token, n)`` over a corpus; special tokens are not counted.

    A task hands on the sums of runs of about ``COUNTED_BYTES`` of text, not a row for each occurrence.
    """
    specials = tuple(specials)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(pc.fill_null(batch.column(0), ""))
            if sum(pc.sum(pc.binary_length(a)).as_py() or 0 for a in held) > COUNTED_BYTES:
                yield from summed(held)
                held = []
        yield from summed(held)

    def summed(held: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        found = pc.value_counts(token_arrays(pa.concat_arrays(held), specials)[0]) if held else None
        if found is not None and len(found):
            counts = pa.table({"token": found.field("values"), "n": found.field("counts")})
            yield from counts.to_batches(max_chunksize=1 << 16)

    parts = spread(df.select(text)).mapInArrow(count, "token STRING, n LONG")
    parts = parts.filter(~F.col("token").isin(list(specials))) if specials else parts
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


def build_vocab(df: DataFrame, text: str = "text", specials: Sequence[str] = ()) -> DataFrame:
    """Learn the vocabulary: ids by falling count, then token; special tokens come last.

    Both the counts and the result are staged, because ranking and every later
    lookup read them several times.
    """
    counts = stage(
        token_counts(df, text, specials).withColumn("rank_count", -F.col("n")), "token-counts"
    )
    order = ["rank_count", "token"]
    ranges = key_ranges(counts, order)
    ranked = running_total(counts, order, out="id", ranges=ranges)
    words = ranked.select(F.col("id").cast("int"), "token", F.lit(False).alias("special"))
    return stage(_append(words, ranges.total, specials), "vocab")


def vocab_size(vocab: DataFrame, added: bool = True) -> int:
    """Number of tokens, with or without the special ones (an action)."""
    return (vocab if added else vocab.filter(~F.col("special"))).count()


def token_ids(vocab: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """Ids of the named tokens (an action with at most ``len(tokens)`` rows)."""
    return {r.token: r.id for r in vocab.filter(F.col("token").isin(list(tokens))).collect()}


def token_id(vocab: DataFrame, token: str) -> int:
    found = token_ids(vocab, [token])
    if token not in found:
        raise KeyError(f"token not in vocabulary: {token!r}")
    return found[token]


def special_tokens_map(vocab: DataFrame, roles: dict[str, str]) -> DataFrame:
    """``(role, token, id)`` of the named roles, e.g. ``{"eos": "<eos>", "pad": "<eos>"}``.

    A role whose token is not in the vocabulary has a null id.
    """
    spark = vocab.sparkSession
    named = spark.createDataFrame(sorted(roles.items()), "role STRING, token STRING")
    wanted = vocab.filter(F.col("token").isin(sorted(set(roles.values())))).select("token", "id")
    return named.join(F.broadcast(wanted), "token", "left").select("role", "token", "id")


def added_tokens(vocab: DataFrame) -> DataFrame:
    return vocab.filter("special").select("id", "token").orderBy("id")


# Fixed value: how reserved tokens are named.
def reserved_tokens(vocab: DataFrame, marker: str = "reserved_special_token") -> DataFrame:
    """Special tokens whose text contains ``marker``."""
    return added_tokens(vocab.filter(F.col("token").contains(marker)))


def rename_token(vocab: DataFrame, old: str, new: str) -> tuple[DataFrame, int]:
    """Give a token a new text and keep its id: ``(vocabulary, id)``."""
    found = token_ids(vocab, [old, new])
    if old not in found:
        raise KeyError(f"token not in vocabulary: {old!r}")
    if new in found and new != old:
        raise ValueError(f"token already in vocabulary: {new!r}")
    hit = F.col("token") == old
    renamed = vocab.select(
        "id",
        F.when(hit, F.lit(new)).otherwise(F.col("token")).alias("token"),
        (F.col("special") | hit).alias("special"),
    )
    return renamed, found[old]


def add_tokens(vocab: DataFrame, tokens: Sequence[str]) -> tuple[DataFrame, int]:
    """Append the tokens that are new, in list order: ``(vocabulary, number added)``."""
    known = token_ids(vocab, tokens)
    fresh = [t for t in dict.fromkeys(tokens) if t not in known]
    top = vocab.agg(F.max("id")).first()[0]
    return _append(vocab, 0 if top is None else top + 1, fresh), len(fresh)


def resize_embeddings(
    vocab: DataFrame, embeddings: DataFrame, width: int, seed: int = 42, scale: float = 0.02
) -> DataFrame:
    """``(id, embedding)`` with one row per vocabulary id.

    Ids without a row get a seeded random normal vector; rows without an id go.
    """
    fresh = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: (normal_hash(F.lit(seed), F.col("id"), i) * scale).cast("float"),
    )
    return (
        vocab.select("id")
        .join(embeddings, "id", "left")
        .select("id", F.coalesce(F.col("embedding"), fresh).alias("embedding"))
    )


def _append(vocab: DataFrame, first_id: int, tokens: Sequence[str]) -> DataFrame:
    if not tokens:
        return vocab
    rows = [(first_id + i, t, True) for i, t in enumerate(tokens)]
    return vocab.unionByName(vocab.sparkSession.createDataFrame(rows, VOCAB_SCHEMA))


def special_ids(vocab: DataFrame) -> list[int]:
    """Ids of the special tokens (a short list kept by the user)."""
    return [r.id for r in vocab.filter("special").select("id").collect()]

