"""A count-based next-token model: fitting, evaluation, deltas, greedy generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.sequences import next_token_pairs
from tokenloom.functions.tokens import split_tokens
from tokenloom.operators import blocks
from tokenloom.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup
from tokenloom.operators.tokenize import numbered_texts
from tokenloom.operators.vocab import token_id, token_ids
from tokenloom.staging import stage

PAIR = ("prev", "next")


def pair_counts(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """``(prev, next, n)`` over all adjacent ids."""
    pairs = df.select(F.explode_outer(next_token_pairs(ids)).alias("p")).filter("p is not null")
    pairs = pairs.select(F.col("p.input").alias("prev"), F.col("p.label").alias("next"))
    return pairs.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))


def text_pair_counts(
    df: DataFrame, vocab: DataFrame, text: str = "text", specials: Sequence[str] = (), unk: str = "<unk>", end: str | None = None
) -> DataFrame:
    """:func:`pair_counts` of the encoded texts: ``(prev, next, n)`` as ids.

    Only the distinct tokens of blocks of texts meet the vocabulary, and pairs are counted within a block before they are
    rows, see :mod:`blocks`.  ``end`` is a token put after every text.
    Runs jobs: the vocabulary is checked and measured, the numbered tokens are staged.
    """
    if blocks.keys_repeat(vocab, ["token"]):
        raise ValueError("the vocabulary has repeated tokens")
    unk_id = token_id(vocab, unk)
    end_id = None if end is None else token_ids(vocab, [end]).get(end, unk_id)
    table = vocab.select("token", F.col("id").alias("token_id"))
    rows, ids = numbered_texts(df, table, [], text, specials, unk_id, fits_broadcast(table))
    pairs = blocks.adjacent(rows, ids, end_id)
    return pairs.groupBy(*PAIR).agg(F.sum("n").alias("n"))


def last_ids(df: DataFrame, vocab: DataFrame, key: Sequence[str], text: str = "text", specials: Sequence[str] = (), unk: str = "<unk>") -> DataFrame:
    """``(key, input_ids)`` with just the last id of each text, which is all a bigram model looks at; a text without tokens has none.

    The last tokens are staged: they are read several times, the texts once.
    """
    last = F.try_element_at(split_tokens(text, specials), F.lit(-1)).alias("token")
    named = lookup(stage(df.select(*key, last), "last-tokens"), vocab.select("token", "id"), "token")
    found = F.when(F.col("token").isNotNull(), F.array(F.coalesce("id", F.lit(token_id(vocab, unk)))))
    return named.select(*key, F.coalesce(found, F.array().cast("array<int>")).alias("input_ids"))


def eval_ngram(model: DataFrame, heldout: DataFrame, vocab_size: int) -> DataFrame:
    """One row ``(tokens, eval_loss, perplexity)`` of held-out pair counts under add-one estimates.

    Both inputs are pair counts, so a frequent pair is one row.  A context may still
    have very many successors; its total is looked up with :func:`lookup`.
    """
    contexts = stage(model.groupBy("prev").agg(F.sum("n").alias("prev_n")), "contexts")
    seen = heldout.join(model.withColumnRenamed("n", "model_n"), list(PAIR), "left")
    scored = lookup(seen, contexts, "prev")
    p = (F.coalesce("model_n", F.lit(0)) + 1) / (F.coalesce("prev_n", F.lit(0)) + vocab_size)
    return (
        scored.agg(F.sum("n").alias("tokens"), F.sum(-F.log(p) * F.col("n")).alias("nll"))
        .withColumn("eval_loss", F.col("nll") / F.col("tokens"))
        .withColumn("perplexity", F.exp("eval_loss"))
        .drop("nll")
    )


def merge_counts(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Base plus delta as one standalone table."""
    d = delta.withColumnRenamed("n", "delta_n")
    total = F.coalesce("n", F.lit(0)) + F.coalesce("delta_n", F.lit(0))
    return base.join(d, list(PAIR), "full_outer").select(*PAIR, total.alias("n"))


def save_delta(delta: DataFrame, path: str) -> None:
    """Write only the delta; the base stays where it is."""
    delta.write.mode("overwrite").parquet(path)


def load_delta(base: DataFrame, path: str) -> DataFrame:
    """A base with a saved delta applied."""
    return merge_counts(base, base.sparkSession.read.parquet(path))


def best_next(model: DataFrame) -> DataFrame:
    """``(prev, next)``: the most frequent successor of each token, the lowest id on ties."""
    return model.groupBy("prev").agg(F.max(F.struct("n", (-F.col("next")).alias("m")))["m"].alias("m")).select(
        "prev", (-F.col("m")).alias("next")
    )


def generate_greedy(
    prompts: DataFrame, model: DataFrame, key: Sequence[str], eos_id: int, max_new: int = 80, ids: str = "input_ids"
) -> DataFrame:
    """``(key, generated)``: up to ``max_new`` new ids per prompt, ending with the end token if reached.

    A continuation depends on the last id only, so one walk is made per distinct last
    id.  Jump tables give the token 1, 2, 4, ... steps on, each joined from the one
    before; from the longest jump down, every position reached so far yields one more.
    That takes about ``2 * log2(max_new)`` joins of narrow tables instead of ``max_new``.
    A walk ends after the end token and at a token without a successor; a prompt without ids has none.
    Runs jobs: the prompts' last ids, the jump tables, the walks and, unless all jump tables together fit a broadcast, each step of them.
    """
    jumps = [stage(best_next(model).filter(F.col("prev") != eos_id), "jump")]
    small = fits_broadcast(jumps[0])  # every later table has fewer rows of the same width
    while 2 ** len(jumps) <= max_new:
        tail = jumps[-1].select(F.col("prev").alias("next"), F.col("next").alias("after"))
        doubled = lookup(jumps[-1], tail, "next", small).filter("after is not null")
        jumps.append(stage(doubled.select("prev", F.col("after").alias("next")), "jump"))
    together = small and fits_broadcast(jumps[0], BROADCAST_BYTES // len(jumps))
    last = stage(prompts.select(*key, F.try_element_at(ids, F.lit(-1)).alias("start")), "prompts")
    walk = last.select("start").distinct().select("start", F.lit(0).alias("step"), F.col("start").alias("prev"))
    for power in reversed(range(len(jumps))):
        if not together:
            walk = stage(walk, "walk")  # one broadcast at a time; the other way of joining reads it several times
        steps = F.explode(F.array(F.lit(0), F.lit(2**power)))
        further = lookup(walk, jumps[power], "prev", small).withColumn("jump", steps)
        walk = further.select(
            "start",
            (F.col("step") + F.col("jump")).alias("step"),
            F.when(F.col("jump") == 0, F.col("prev")).otherwise(F.col("next")).alias("prev"),
        ).filter(F.col("prev").isNotNull() & (F.col("step") <= max_new))
    chain = F.sort_array(F.collect_list(F.struct("step", "prev")))["prev"].alias("generated")
    chains = stage(walk.filter("step > 0").groupBy("start").agg(chain), "chains")
    return lookup(last, chains, "start").select(
        *key, F.coalesce("generated", F.array().cast("array<int>")).alias("generated")
    )
