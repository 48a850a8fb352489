"""From raw tables to packed sequences and model scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.prompts import prompt_full
from tokenloom.functions.sequences import with_bos, with_eos
from tokenloom.operators.bigram import eval_ngram, text_pair_counts
from tokenloom.operators.lookup import BROADCAST_BYTES, fits_broadcast
from tokenloom.operators.ordering import div
from tokenloom.operators.packing import pack_overlap
from tokenloom.operators.splits import SHUFFLE_KEY, assign_split
from tokenloom.operators.tokenize import encode, token_lengths
from tokenloom.operators.vocab import build_vocab, token_ids, vocab_size
from tokenloom.staging import spread, stage

# The special tokens of the learned vocabularies.
UNK, BOS, EOS = "<unk>", "<bos>", "<eos>"
SPECIALS = (UNK, BOS, EOS)


def pack_corpus(
    df: DataFrame,
    vocab: DataFrame,
    order_by: Sequence[str],
    packer: Callable[..., DataFrame] = pack_overlap,
    text: str = "text",
    specials: Sequence[str] = SPECIALS,
    bos: str | None = None,
    eos: str | None = EOS,
    limit: int = BROADCAST_BYTES,
    **packer_args,
) -> DataFrame:
    """Encode texts and pack the ids; a vocabulary over ``limit`` bytes is not broadcast.

    The length of every sequence is known from its text alone.  The lengths and the ids are
    staged, the stream is laid out from the lengths (key and one number per row), and the ids
    go to their key range once, where they are put in order and packed.
    """
    marks = [m for m in (UNK, bos, eos) if m is not None]
    known = token_ids(vocab, marks)
    small = fits_broadcast(vocab.select("token", "id"), limit)
    texts = df.select(*order_by, text)
    sizes = token_lengths(spread(texts), text, specials)
    sizes = stage(sizes.select(*order_by, (F.col("n") + len(marks) - 1).alias("n")), "lengths")
    ids = encode(texts, vocab, order_by, text, specials, small=small, unk_id=known[UNK], limit=limit)
    if bos is not None:
        ids = ids.withColumn("input_ids", with_bos("input_ids", known[bos]))
    if eos is not None:
        ids = ids.withColumn("input_ids", with_eos("input_ids", known[eos]))
    return packer(stage(ids, "ids"), order_by, sizes=sizes, **packer_args)


def pack_instructions(instructions: DataFrame, length: int, **args) -> DataFrame:
    """Prompt texts of instruction rows, packed with a vocabulary learned from them."""
    texts = stage(instructions.select("id", prompt_full().alias("text")), "prompts")
    vocab = build_vocab(texts, specials=SPECIALS)
    return pack_corpus(texts, vocab, ["id"], length=length, **args)


def train_pack_plan(
    instructions: DataFrame, length: int, held_out: int, seed: int = 42, batch: int = 8, **args
) -> DataFrame:
    """Prompts, seeded shuffle, hold-out, and each split packed in shuffled order: ``(split, batch, seq_id, ..)``.

    The vocabulary is learned from all prompts.  Stages the prompts and runs the jobs of a hold-out
    and of two packings.
    """
    texts = stage(instructions.select("id", prompt_full().alias("text")), "prompts")
    vocab = build_vocab(texts, specials=SPECIALS)
    both = stage(assign_split(texts, "id", held_out, seed), "splits")
    order = [SHUFFLE_KEY, "id"]
    parts = [
        pack_corpus(both.filter(F.col("split") == s), vocab, order, length=length, **args).withColumn("split", F.lit(s))
        for s in ("train", "eval")
    ]
    return parts[0].unionByName(parts[1]).withColumn("batch", div(F.col("seq_id"), batch))


def ngram_perplexity(train: DataFrame, heldout: DataFrame, text: str = "text") -> DataFrame:
    """Fit a vocabulary and a bigram model on ``train``; loss and perplexity on ``heldout``.

    Pairs are counted straight from the texts, so no text is encoded.
    """
    vocab = build_vocab(train, text, SPECIALS)
    model, seen = (stage(text_pair_counts(df, vocab, text, SPECIALS, UNK), "pairs") for df in (train, heldout))
    return eval_ngram(model, seen, vocab_size(vocab))
