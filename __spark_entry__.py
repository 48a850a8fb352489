
from __future__ import annotations

import importlib
import importlib.util
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from tokenloom.functions import losses, prompts, sequences, templates
from tokenloom.functions.tokens import split_tokens
from tokenloom.operators import balance, batches, bestfit, bigram, classifier, metrics, packing, splits, tokenize, udfs, vectors, vocab
from tokenloom.operators.lookup import lookup
from tokenloom.plans import flows
from tokenloom.plans.flows import BOS, EOS, SPECIALS, UNK
from tokenloom.sources import sinks, tables
from tokenloom.staging import spread, stage, staging_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED, HELD_OUT, SHORT, LONG, BATCH, RANKS, EPOCHS = 42, 50, 64, 128, 8, 4, 3
TEMPLATE = prompts.ChatTemplate()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def entry(spark: SparkSession) -> DataFrame:
    """Conversations to prompts to packed sequences, with a vocabulary learned on the way."""
    return flows.pack_instructions(_instructions(spark, "/root/testdata/sf0.001"), SHORT)


def queries() -> dict[str, Query]:
    return {**QUERIES, **(llm_queries.queries() if llm_queries else {}), **({"pipeline": pipeline} if corpus_pipeline else {})}


def oracle_sql() -> dict[str, str]:
    sql = {**oracle_queries.build(), **(llm_queries.oracle_sql() if llm_queries else {})}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


def _optional(module: str):
    """The module, or None where its file (or the subpackage) is not there; its own errors are not hidden."""
    try:
        found = importlib.util.find_spec(module)
    except ModuleNotFoundError:
        found = None
    return importlib.import_module(module) if found else None


llm_queries = _optional("tokenloom.llm.queries")
# Its stages are operators of the subpackage, so it is there only with it.
corpus_pipeline = _optional("corpus_pipeline") if llm_queries else None


# --- inputs -----------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", "text")


def _instructions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.from_conversations(_table(spark, sf, "conversations"))


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.build_vocab(_documents(spark, sf), specials=SPECIALS)


def _encoded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The documents' vocabulary and their ids."""
    v = _vocab(spark, sf)
    return v, tokenize.encode(_documents(spark, sf), v, ["doc_id"], specials=SPECIALS)


def _packed(spark: SparkSession, sf: str, packer, **args) -> DataFrame:
    return flows.pack_corpus(_documents(spark, sf), _vocab(spark, sf), ["doc_id"], packer, **args)


def _shards(spark: SparkSession, sf: str) -> DataFrame:
    """One summed embedding vector per shard."""
    rows = _table(spark, sf, "embeddings").select(
        (F.col("vec_id") % RANKS).cast("int").alias("shard"), F.col("embedding").alias("vec")
    )
    return stage(vectors.vector_sum(rows, by="shard"), "shards")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings read as class scores."""
    return metrics.score(_table(spark, sf, "embeddings"), "embedding", "label")


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select((F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/tokenloom/{name}-{uuid.uuid4().hex}"


def _joined(column: str | Column) -> Column:
    """A list as comma-separated text, which both engines print alike."""
    c = F.col(column) if isinstance(column, str) else column
    return F.array_join(c.cast("array<string>"), ",")


def _elements(df: DataFrame, *keys: str, vec: str = "vec") -> DataFrame:
    return df.select(*keys, F.posexplode(vec).alias("pos", "x")).withColumn("x", F.round(F.col("x").cast("double"), 6))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and sinks ------------------------------------------------------


@query
def instructions(spark, sf):
    return _instructions(spark, sf)


@query
def instructions_with_gaps(spark, sf):
    """Turn numbers that are not consecutive: seven times as far apart."""
    return tables.from_conversations(_table(spark, sf, "conversations").withColumn("turn", F.col("turn") * 7), stride=100_000)


@query
def instructions_from_json(spark, sf):
    path = _folder(spark, "instructions")
    _instructions(spark, sf).select("instruction", "input", "output").write.json(path)
    return tables.read_instructions(spark, path, lines=True)


@query
def instructions_from_array(spark, sf):
    """One array in one file, read in two dozen byte ranges; every text holds quotes, escapes and braces."""
    path = _folder(spark, "array")
    hard = F.concat("instruction", F.lit(' "}{\\" [{"a": "\\\\"}], \n}'))
    rows = _instructions(spark, sf).select("id", F.to_json(F.struct(hard.alias("instruction"), "input", "output")).alias("value"))
    rows = batches.with_ordinal(stage(rows, "instructions"), ["id"])
    mark = F.when(F.col("ordinal") == 0, "[").otherwise(",")
    ends = spark.createDataFrame([(1 << 60, "]")], "ordinal LONG, value STRING")
    lines = rows.select("ordinal", F.concat(mark, "value").alias("value")).unionByName(ends)
    lines.repartition(1).sortWithinPartitions("ordinal").select("value").write.text(path)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    return tables.read_instructions(spark, path, range_bytes=-(-size // 24)).drop("file")


@query
def text_splits(spark, sf):
    """Plain text files, one folder for each split: both splits by name, and their words."""
    path = _folder(spark, "splits")
    lines = _documents(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    lines.filter("doc_id % 10 = 0").select("value").write.text(f"{path}/split=validation")
    lines.filter("doc_id % 10 <> 0").select("value").write.text(f"{path}/split=train")
    both = [tables.read_text(spark, path, s, plain=True).select("text", F.lit(s).alias("split")) for s in ("train", "validation")]
    every = both[0].unionByName(both[1])
    return every.groupBy("split", "text").agg(F.count(F.lit(1)).alias("n"))


@query
def text_corpus(spark, sf):
    return tables.read_text(spark, f"{sf}/documents.parquet").select("doc_id", "text")


@query
def labelled_text(spark, sf):
    return tables.read_labelled(spark, f"{sf}/documents.parquet", f"{sf}/labels.parquet")


def _written(spark: SparkSession, sf: str) -> DataFrame:
    """Both splits of the documents, packed, written and read again."""
    path = _folder(spark, "packed")
    both = splits.assign_split(_documents(spark, sf), "doc_id", HELD_OUT, SEED)
    v = _vocab(spark, sf)
    parts = [
        flows.pack_corpus(both.filter(F.col("split") == s), v, ["doc_id"], length=LONG).withColumn("split", F.lit(s))
        for s in ("train", "eval")
    ]
    sinks.write_packed(parts[0].unionByName(parts[1]), path)
    read = [sinks.read_packed(spark, path, s).withColumn("split", F.lit(s)) for s in ("train", "eval")]
    return read[0].unionByName(read[1])


@query
def packed_written(spark, sf):
    return _written(spark, sf).select("split", "seq_id", _joined("labels").alias("labels"))


@query
def stored_share(spark, sf):
    """The second of four shares of what is left of a packed store from sequence 500 on."""
    path = _folder(spark, "store")
    packed = _packed(spark, sf, packing.pack_overlap, length=LONG).select("seq_id", "input_ids")
    sinks.write_store(packed, path, per_file=200)
    rows = sinks.read_store(spark, path, rank=1, ranks=RANKS, start=500)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"))


@query
def steps_to_save(spark, sf):
    plan = _metrics(spark, sf).withColumn("epoch_end", F.col("step") % 500 == 0)
    return sinks.save_due(plan, 40).select("step", "loss")


@query
def resume_plan(spark, sf):
    path = _folder(spark, "steps")
    plan = _metrics(spark, sf)
    total = plan.count()
    for step in (total * 9 // 10, total // 2):
        sinks.write_step(plan.filter(F.col("step") == step).select("loss"), path, step)
    return sinks.resume_after(plan, sinks.latest_step(spark, path))


@query
def packed_both_splits(spark, sf):
    return _written(spark, sf).select("split", "seq_id", _joined("input_ids").alias("input_ids"))


@query
def resume_after_empty_state(spark, sf):
    path = _folder(spark, "steps")
    plan = _metrics(spark, sf)
    total = plan.count()
    sinks.write_step(plan.filter(F.col("step") == total // 2).select("loss"), path, total // 2)
    sinks.write_step(plan.limit(0).select("loss"), path, total * 3 // 4)
    return sinks.resume_after(plan, sinks.latest_step(spark, path))


@query
def logged_steps(spark, sf):
    return metrics.log_every(_metrics(spark, sf), 5, first=True)


# --- projections ------------------------------------------------------------


@query
def count_rows(spark, sf):
    return _instructions(spark, sf).agg(F.count(F.lit(1)).alias("rows"))


@query
def row_at(spark, sf):
    return batches.row_at(stage(_instructions(spark, sf), "instructions"), ["id"], 32)


@query
def with_input(spark, sf):
    return _instructions(spark, sf).filter(prompts.has_input())


@query
def first_with_input(spark, sf):
    return _instructions(spark, sf).filter(prompts.has_input()).orderBy("id").limit(1)


@query
def preview(spark, sf):
    return _instructions(spark, sf).select("id", F.substring("output", 1, 100).alias("preview"))


@query
def rename_and_drop(spark, sf):
    return _table(spark, sf, "labels").withColumnRenamed("quality", "labels").drop("toxic")


# --- prompts and chat -------------------------------------------------------


@query
def prompt_only(spark, sf):
    return _instructions(spark, sf).select("id", prompts.prompt_only().alias("prompt"))


@query
def prompt_completion(spark, sf):
    rows = _instructions(spark, sf).select(
        "id", prompts.prompt_only().alias("prompt"), prompts.completion(eos=EOS).alias("output")
    )
    return rows.withColumn("example", F.concat("prompt", "output"))


@query
def prompt_full(spark, sf):
    return _instructions(spark, sf).select("id", prompts.prompt_full().alias("text"))


@query
def prompt_variant(spark, sf):
    return _instructions(spark, sf).select("id", prompts.prompt_full(variant=True).alias("text"))


@query
def chat_messages(spark, sf):
    rows = _instructions(spark, sf).select("id", F.posexplode(prompts.to_messages()).alias("pos", "m"))
    return rows.select("id", "pos", "m.role", "m.content")


@query
def rendered_chat(spark, sf):
    return _instructions(spark, sf).select("id", prompts.render_chat(prompts.to_messages()).alias("text"))


@query
def tokenized_chat(spark, sf):
    specials = (*SPECIALS, *[s for s in TEMPLATE.specials if s not in SPECIALS])
    chats = _instructions(spark, sf).select("id", prompts.render_chat(prompts.to_messages()).alias("text"))
    chats = stage(chats, "chats")
    v = vocab.build_vocab(chats, specials=specials)
    ids = tokenize.encode(chats, v, ["id"], specials=specials)
    head = ids.select("id", F.slice("input_ids", 1, 15).alias("input_ids"))
    return tokenize.decode_tokens(head, v, ["id"])


def _published(spark: SparkSession, sf: str, template: str, generate: bool = False) -> DataFrame:
    rows = _instructions(spark, sf).select("id", prompts.to_messages().alias("messages"))
    messages = F.slice("messages", 1, 2) if generate else F.col("messages")
    text = templates.compile_template(template, messages=messages, bos_token=BOS, eos_token=EOS, add_generation_prompt=generate)
    return rows.select("id", text.alias("text"))


# Three chat templates as models publish them.
CHATML = (
    "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\n' + message['content'] + '<|im_end|>' + '\n'}}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\n' }}{% endif %}"
)
HEADERS = (
    "{% set loop_messages = messages %}{% for message in loop_messages %}"
    "{% set content = '<|start_header_id|>' + message['role'] + '<|end_header_id|>\n\n'+ message['content'] | trim + '<|eot_id|>' %}"
    "{% if loop.index0 == 0 %}{% set content = bos_token + content %}{% endif %}{{ content }}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|start_header_id|>assistant<|end_header_id|>\n\n' }}{% endif %}"
)
BY_ROLE = (
    "{% for message in messages %}\n{% if message['role'] == 'user' %}\n{{ '<|user|>\n' + message['content'] + eos_token }}\n"
    "{% elif message['role'] == 'system' %}\n{{ '<|system|>\n' + message['content'] + eos_token }}\n"
    "{% elif message['role'] == 'assistant' %}\n{{ '<|assistant|>\n'  + message['content'] + eos_token }}\n{% endif %}\n"
    "{% if loop.last and add_generation_prompt %}\n{{ '<|assistant|>' }}\n{% endif %}\n{% endfor %}"
)


@query
def template_chatml(spark, sf):
    return _published(spark, sf, CHATML)


@query
def template_headers(spark, sf):
    return _published(spark, sf, HEADERS)


@query
def template_by_role(spark, sf):
    """System and user messages, with the heading of the answer to come."""
    return _published(spark, sf, BY_ROLE, generate=True)


# --- splits and order -------------------------------------------------------


@query
def shuffled(spark, sf):
    keyed = splits.with_shuffle_key(_table(spark, sf, "documents").select("doc_id"), "doc_id", SEED)
    return batches.with_ordinal(keyed, ["shuffle_key", "doc_id"])


@query
def holdout(spark, sf):
    rows = splits.assign_split(_table(spark, sf, "documents"), "doc_id", HELD_OUT, SEED)
    return rows.select("doc_id", "split")


@query
def holdout_everything(spark, sf):
    rows = splits.assign_split(_table(spark, sf, "documents"), "doc_id", 10**9, SEED)
    return rows.select("doc_id", "split")


@query
def sample(spark, sf):
    return splits.sample_n(_table(spark, sf, "documents"), "doc_id", 100, SEED).select("doc_id", "lang")


@query
def epoch_order(spark, sf):
    return splits.epoch_order(_table(spark, sf, "documents").select("doc_id"), "doc_id", SEED, EPOCHS)


@query
def epoch_places(spark, sf):
    placed = splits.epoch_places(_table(spark, sf, "documents").select("doc_id"), ["doc_id"], SEED, EPOCHS)
    return placed.select("doc_id", "epoch", "place")


@query
def resume_inside_epoch(spark, sf):
    """The rest of the second epoch, once three fifths of it are done."""
    docs = stage(batches.with_ordinal(_table(spark, sf, "documents").select("doc_id"), ["doc_id"]), "ordinals")
    n = docs.count()
    return splits.rows_at_places(docs, n, SEED, 1, n * 3 // 5, n).select("place", "doc_id")


# --- vocabulary and tokens --------------------------------------------------


@query
def build_vocab(spark, sf):
    return _vocab(spark, sf)


@query
def vocab_sizes(spark, sf):
    plain = (~F.col("special")).cast("long")
    return _vocab(spark, sf).agg(F.count(F.lit(1)).alias("with_added"), F.sum(plain).alias("without_added"))


@query
def encode(spark, sf):
    _, ids = _encoded(spark, sf)
    return ids.select("doc_id", _joined("input_ids").alias("input_ids"))


@query
def encode_large_vocab(spark, sf):
    """As ``encode``, with no vocabulary small enough for a broadcast."""
    ids = tokenize.encode(_documents(spark, sf), _vocab(spark, sf), ["doc_id"], specials=SPECIALS, limit=0)
    return ids.select("doc_id", _joined("input_ids").alias("input_ids"))


@query
def decode_large_vocab(spark, sf):
    """As ``decode``; the most frequent tokens are broadcast, the others looked up by range."""
    v, ids = _encoded(spark, sf)
    return tokenize.decode(ids, v, ["doc_id"], limit=100_000)


@query
def encode_unknown(spark, sf):
    ids = tokenize.encode(_table(spark, sf, "benchmark"), _vocab(spark, sf), ["item_id"], specials=SPECIALS)
    return ids.select("item_id", _joined("input_ids").alias("input_ids"))


@query
def decode_tokens(spark, sf):
    v, ids = _encoded(spark, sf)
    return tokenize.decode_tokens(ids, v, ["doc_id"])


@query
def decode(spark, sf):
    v, ids = _encoded(spark, sf)
    return tokenize.decode(ids, v, ["doc_id"])


@query
def token_count(spark, sf):
    return tokenize.token_lengths(_documents(spark, sf)).select("doc_id", "n")


@query
def with_bos_and_eos(spark, sf):
    v, ids = _encoded(spark, sf)
    known = vocab.token_ids(v, [BOS, EOS])
    marked = sequences.with_eos(sequences.with_bos("input_ids", known[BOS]), known[EOS])
    return ids.select("doc_id", _joined(marked).alias("input_ids"))


@query
def special_tokens_map(spark, sf):
    return vocab.special_tokens_map(_vocab(spark, sf), {"bos": BOS, "eos": EOS, "pad": EOS, "unk": UNK})


@query
def added_tokens(spark, sf):
    return vocab.added_tokens(_vocab(spark, sf))


@query
def reserved_tokens(spark, sf):
    reserved = [f"<reserved_special_token_{i}>" for i in range(8)]
    v = vocab.build_vocab(_documents(spark, sf), specials=(*SPECIALS, *reserved))
    return vocab.reserved_tokens(v)


@query
def rename_token(spark, sf):
    renamed, _ = vocab.rename_token(_vocab(spark, sf), BOS, "<tool_call>")
    return renamed


@query
def add_tokens(spark, sf):
    grown, _ = vocab.add_tokens(_vocab(spark, sf), ["<TIME>", EOS, "<DATE>", "<LOCATION>"])
    return grown


@query
def token_lookup(spark, sf):
    tokens = _table(spark, sf, "benchmark").select(
        F.explode(split_tokens("text")).alias("token")
    ).distinct()
    return lookup(tokens, _vocab(spark, sf).select("token", "id"), "token")


@query
def resize_embeddings(spark, sf):
    known = _table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), "embedding")
    grown = vocab.resize_embeddings(_vocab(spark, sf), known, 64)
    return grown.select("id", F.size("embedding").alias("width"))


@query
def resized_values(spark, sf):
    """Every element of the vectors that were there; new ones by their width and range."""
    known = _table(spark, sf, "embeddings").select(F.col("vec_id").cast("int").alias("id"), "embedding")
    grown = vocab.resize_embeddings(_vocab(spark, sf), known, 64).join(
        known.select("id", F.lit(True).alias("old")), "id", "left"
    )
    small = F.forall("embedding", lambda x: F.abs(x) < 0.2)
    shown = F.transform("embedding", lambda x: F.round(x.cast("double"), 6).cast("decimal(12,6)"))
    return grown.select("id", F.when(F.col("old"), _joined(shown)).when(small, "new").alias("vec"))


@query
def encode_added(spark, sf):
    specials = (*SPECIALS, "<SEP>")
    v, _ = vocab.add_tokens(_vocab(spark, sf), ["<SEP>"])
    marked = _documents(spark, sf).withColumn("text", F.replace("text", F.lit(","), F.lit("<SEP>")))
    ids = tokenize.encode(marked, v, ["doc_id"], specials=specials)
    return ids.select("doc_id", _joined("input_ids").alias("input_ids"))


@query
def decode_generated(spark, sf):
    texts = _instructions(spark, sf).select("id", prompts.prompt_only().alias("prompt"), "output")
    both = stage(texts, "texts").select("id", F.posexplode(F.array("prompt", "output")).alias("part", "text"))
    v = vocab.build_vocab(both, specials=SPECIALS)
    ids = stage(tokenize.encode(both, v, ["id", "part"], specials=SPECIALS), "parts")
    pairs = ids.filter("part = 0").select("id", F.col("input_ids").alias("prompt")).join(
        ids.filter("part = 1").select("id", F.col("input_ids").alias("output")), "id"
    )
    whole = sequences.with_eos(F.concat("prompt", "output"), vocab.token_id(v, EOS))
    new = sequences.strip_generated(whole, F.size("prompt"), vocab.special_ids(v))
    return tokenize.decode(pairs.select("id", new.alias("input_ids")), v, ["id"])


# --- sequence shaping -------------------------------------------------------


@query
def pad_right(spark, sf):
    v, ids = _encoded(spark, sf)
    pad_id = vocab.token_id(v, EOS)
    return ids.select(
        "doc_id",
        _joined(sequences.pad("input_ids", SHORT, pad_id)).alias("input_ids"),
        _joined(sequences.attention_mask("input_ids", SHORT)).alias("attention_mask"),
    )


@query
def pad_left(spark, sf):
    v, ids = _encoded(spark, sf)
    pad_id = vocab.token_id(v, EOS)
    return ids.select(
        "doc_id",
        _joined(sequences.pad("input_ids", SHORT, pad_id, "left")).alias("input_ids"),
        _joined(sequences.attention_mask("input_ids", SHORT, "left")).alias("attention_mask"),
    )


@query
def truncate(spark, sf):
    _, ids = _encoded(spark, sf)
    return ids.select("doc_id", _joined(sequences.truncate("input_ids", SHORT)).alias("input_ids"))


@query
def pad_and_truncate(spark, sf):
    v, ids = _encoded(spark, sf)
    cut = sequences.fit("input_ids", SHORT, vocab.token_id(v, EOS))
    mask = sequences.attention_mask(sequences.truncate("input_ids", SHORT), SHORT)
    return ids.select("doc_id", _joined(cut).alias("input_ids"), _joined(mask).alias("attention_mask"))


@query
def next_token_pairs(spark, sf):
    _, ids = _encoded(spark, sf)
    steps = ids.select("doc_id", F.posexplode(sequences.next_token_pairs("input_ids")).alias("step", "p"))
    return steps.select("doc_id", "step", "p.input", "p.label")


@query
def padding_waste(spark, sf):
    _, ids = _encoded(spark, sf)
    return _rounded(packing.padding_waste(ids, LONG), "pad_percent")


@query
def layout(spark, sf):
    v = _vocab(spark, sf)
    eos = vocab.token_id(v, EOS)
    packed = flows.pack_corpus(_documents(spark, sf), v, ["doc_id"], packing.pack_padded, length=20, pad_id=eos)
    return packed.select("seq_id", sequences.layout_string("input_ids", eos, eos).alias("layout"))


@query
def sample_layout(spark, sf):
    _, ids = _encoded(spark, sf)
    return ids.select("doc_id", sequences.sample_layout("input_ids", LONG).alias("layout"))


@query
def pack_disjoint(spark, sf):
    rows = _packed(spark, sf, packing.pack_disjoint, length=LONG, bos=BOS, eos=EOS)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), _joined("labels").alias("labels"))


@query
def pack_disjoint_plain(spark, sf):
    rows = _packed(spark, sf, packing.pack_disjoint, length=15, eos=None)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), _joined("labels").alias("labels"))


@query
def pack_overlap(spark, sf):
    rows = _packed(spark, sf, packing.pack_overlap, length=LONG)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), _joined("labels").alias("labels"))


@query
def pack_overlap_large_vocab(spark, sf):
    rows = flows.pack_corpus(_documents(spark, sf), _vocab(spark, sf), ["doc_id"], packing.pack_overlap, length=LONG, limit=0)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), _joined("labels").alias("labels"))


@query
def pack_constant_length(spark, sf):
    rows = flows.pack_instructions(_instructions(spark, sf), SHORT, packer=packing.pack_constant_length)
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), _joined("labels").alias("labels"))


@query
def pack_best_fit(spark, sf):
    v, ids = _encoded(spark, sf)
    rows = bestfit.pack_best_fit(stage(ids, "ids"), "doc_id", LONG, vocab.token_id(v, EOS))
    lists = [_joined(c).alias(c) for c in ("input_ids", "lengths", "keys")]
    return rows.select("seq_id", *lists, "real")


@query
def best_fit_report(spark, sf):
    lengths = tokenize.token_lengths(_documents(spark, sf)).select("doc_id", "n")
    return _rounded(bestfit.bin_report(bestfit.assign_bins(lengths, "doc_id", LONG), LONG), "pad_percent")


@query
def pack_padded(spark, sf):
    v = _vocab(spark, sf)
    rows = flows.pack_corpus(
        _documents(spark, sf), v, ["doc_id"], packing.pack_padded, length=20, pad_id=vocab.token_id(v, EOS)
    )
    return rows.select("seq_id", _joined("input_ids").alias("input_ids"), "real")


@query
def group_texts(spark, sf):
    _, ids = _encoded(spark, sf)
    blocks = packing.group_texts(stage(ids, "ids"), ["doc_id"], LONG, batch=100)
    return blocks.select(
        "worker",
        "batch",
        "block",
        _joined("input_ids").alias("input_ids"),
        _joined("attention_mask").alias("attention_mask"),
        _joined("labels").alias("labels"),
    )


@query
def packing_report(spark, sf):
    texts = spread(_documents(spark, sf))
    lengths = texts.select(split_tokens("text", SPECIALS).alias("input_ids"))
    return _rounded(packing.packing_report(lengths, LONG), "percent_before", "percent_after")


# --- batches and plans ------------------------------------------------------


def _batched(spark: SparkSession, sf: str) -> DataFrame:
    return batches.assign_batches(_table(spark, sf, "documents").select("doc_id", "n_chars"), ["doc_id"], BATCH)


@query
def assign_batches(spark, sf):
    return _batched(spark, sf)


@query
def order_by_timestamp(spark, sf):
    lines = _table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    placed = batches.with_ordinal(lines, ["l_shipdate", "l_orderkey", "l_linenumber"])
    return placed.select("l_orderkey", "l_linenumber", "ordinal")


@query
def collate_with_hook(spark, sf):
    def longest(rows: Column) -> Column:
        return F.array_max(F.transform(rows, lambda r: r["n_chars"]))

    made = batches.collate(_batched(spark, sf), ["n_chars"], hook=longest)
    return made.select("batch", F.col("rows").alias("longest"))


@query
def collate(spark, sf):
    rows = batches.collate(_batched(spark, sf), ["doc_id"])
    return rows.select("batch", _joined("rows.doc_id").alias("doc_ids"))


@query
def shard_by_rank(spark, sf):
    return batches.shard_by_rank(_batched(spark, sf), RANKS).select("doc_id", "batch", "rank")


def _updates(spark: SparkSession, sf: str, accum: int, mode: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id")
    steps = batches.assign_batches(docs, ["doc_id"], BATCH).select(F.col("batch").alias("step")).distinct()
    rows = docs.count()
    per_epoch = rows // BATCH if mode == "pipeline" else -(-rows // BATCH)
    return batches.assign_updates(steps, EPOCHS, per_epoch, accum, mode)


@query
def updates_vanilla(spark, sf):
    return _updates(spark, sf, 4, "vanilla")


@query
def updates_accelerate(spark, sf):
    return _updates(spark, sf, 8, "accelerate")


@query
def updates_pipeline(spark, sf):
    return _updates(spark, sf, 8, "pipeline")


@query
def plan_summary(spark, sf):
    docs = _table(spark, sf, "documents")
    plans = [
        batches.plan_summary(docs, BATCH, RANKS, 8, EPOCHS, m).withColumn("mode", F.lit(m))
        for m in (*batches.MODES, "raw")
    ]
    return plans[0].union(plans[1]).union(plans[2]).union(plans[3])


@query
def shard_by_least_weight(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return balance.shard_by_least_weight(docs, ["doc_id"], "n_chars", RANKS)


@query
def shard_by_weight(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return batches.shard_by_weight(docs, ["doc_id"], "n_chars", RANKS)


# --- evaluation -------------------------------------------------------------


@query
def cross_entropy(spark, sf):
    return _rounded(_scored(spark, sf).select("vec_id", "loss"), "loss")


@query
def cross_entropy_ignored(spark, sf):
    rows = _table(spark, sf, "embeddings").withColumn(
        "label", F.when(F.col("label") == 0, losses.IGNORED_LABEL).otherwise(F.col("label"))
    )
    scored = metrics.score(rows, "embedding", "label", lambda x, y: losses.cross_entropy(x, y, losses.IGNORED_LABEL))
    return _rounded(scored.agg(F.count("loss").alias("rows"), F.avg("loss").alias("loss")), "loss")


def _sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as the scores of positions in sequences of growing length; every fifth position is left out."""
    rows = _table(spark, sf, "embeddings").withColumn("seq", F.floor(F.sqrt("vec_id")))
    label = F.when(F.col("vec_id") % 5 == 0, losses.IGNORED_LABEL).otherwise(F.col("label")).cast("int")
    steps = F.sort_array(F.collect_list(F.struct("vec_id", F.col("embedding").alias("x"), label.alias("y"))))
    made = rows.groupBy("seq").agg(steps.alias("steps"))
    return made.select("seq", losses.sequence_loss("steps.x", "steps.y").alias("loss"))


@query
def sequence_loss(spark, sf):
    return _rounded(_sequences(spark, sf).select("seq", "loss.loss", "loss.count"), "loss")


@query
def sequence_eval_loss(spark, sf):
    return _rounded(metrics.eval_loss_by_position(_sequences(spark, sf)), "eval_loss")


@query
def eval_loss_by_batch(spark, sf):
    rows = batches.assign_batches(_table(spark, sf, "embeddings"), ["vec_id"], BATCH)
    return _rounded(metrics.eval_loss_by_batch(metrics.score(rows, "embedding", "label")), "eval_loss")


@query
def eval_loss_reduced(spark, sf):
    rows = batches.assign_batches(_table(spark, sf, "embeddings"), ["vec_id"], BATCH)
    scored = metrics.score(batches.shard_by_rank(rows, RANKS), "embedding", "label")
    return _rounded(metrics.eval_loss_reduced(scored), "total_loss", "eval_loss")


@query
def perplexity(spark, sf):
    rows = batches.assign_batches(_table(spark, sf, "embeddings"), ["vec_id"], BATCH)
    loss = metrics.eval_loss_by_batch(metrics.score(rows, "embedding", "label"))
    return loss.select(F.round(losses.perplexity("eval_loss"), 2).alias("perplexity"))


@query
def argmax(spark, sf):
    return _scored(spark, sf).select("vec_id", "prediction")


@query
def accuracy(spark, sf):
    return _rounded(metrics.accuracy(_scored(spark, sf)), "accuracy")


# --- vectors across shards --------------------------------------------------


@query
def broadcast_vector(spark, sf):
    return _elements(vectors.broadcast_vector(_shards(spark, sf)), "shard")


@query
def vector_sum(spark, sf):
    return _elements(vectors.vector_sum(_table(spark, sf, "embeddings"), "embedding"), vec="embedding")


@query
def vector_sum_all(spark, sf):
    return _elements(vectors.vector_sum_all(_shards(spark, sf)), "shard")


@query
def gather_vectors(spark, sf):
    lists = vectors.gather_vectors(_shards(spark, sf)).select(F.posexplode("vecs").alias("item", "vec"))
    return _elements(lists, "item")


@query
def gather_vectors_all(spark, sf):
    lists = vectors.gather_vectors_all(_shards(spark, sf)).select("shard", F.posexplode("vecs").alias("item", "vec"))
    return _elements(lists, "shard", "item")


@query
def scatter_vectors(spark, sf):
    return _elements(vectors.scatter_vectors(vectors.gather_vectors(_shards(spark, sf))), "shard")


@query
def segment_sum(spark, sf):
    rows = _table(spark, sf, "embeddings").select(F.col("embedding").alias("vec"))
    return _elements(vectors.segment_sum(rows, RANKS), "shard")


@query
def quantize_vectors(spark, sf):
    coded = vectors.quantize_vectors(_table(spark, sf, "embeddings").select("vec_id", "embedding"), block=16)
    blocks = coded.select("vec_id", "codes", F.posexplode("scales").alias("block", "scale"))
    codes = F.slice("codes", F.col("block") * 16 + 1, F.lit(16))
    return blocks.select("vec_id", "block", F.round("scale", 6).alias("scale"), _joined(codes).alias("codes"))


@query
def dequantize_vectors(spark, sf):
    coded = vectors.quantize_vectors(_table(spark, sf, "embeddings").select("vec_id", "embedding"), block=16)
    return _elements(vectors.dequantize_vectors(coded, block=16), "vec_id", vec="embedding")


def _double_quantized(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, float]:
    coded = vectors.quantize_vectors(_table(spark, sf, "embeddings").select("vec_id", "embedding"), block=16)
    return vectors.quantize_scales(stage(coded, "coded"), ["vec_id"], per_vector=4)


@query
def quantize_scales(spark, sf):
    coded, _, _ = _double_quantized(spark, sf)
    return coded.select("vec_id", F.posexplode("scale_codes").alias("block", "code"))


@query
def dequantize_scales(spark, sf):
    coded, tops, mean = _double_quantized(spark, sf)
    back = vectors.dequantize_scales(stage(coded, "coded"), ["vec_id"], tops, mean, per_vector=4)
    return back.select("vec_id", F.posexplode("scales").alias("block", "x")).withColumn("scale", F.round("x", 6)).drop("x")


# --- models -----------------------------------------------------------------


@query
def classifier_accuracy(spark, sf):
    rows = tables.read_labelled(spark, f"{sf}/documents.parquet", f"{sf}/labels.parquet")
    train, held = splits.holdout(rows, "doc_id", HELD_OUT, SEED)
    weights = classifier.train_gradient(classifier.hashed_features(train, "doc_id"))
    scored = classifier.classify_gradient(classifier.hashed_features(held, "doc_id"), weights)
    return _rounded(metrics.accuracy(scored), "accuracy")


@query
def naive_bayes(spark, sf):
    rows = tables.read_labelled(spark, f"{sf}/documents.parquet", f"{sf}/labels.parquet")
    train, held = splits.holdout(rows, "doc_id", HELD_OUT, SEED)
    model = classifier.train_naive_bayes(train)
    return classifier.classify_naive_bayes(model, held, "doc_id")


@query
def train_pack_plan(spark, sf):
    plan = flows.train_pack_plan(_instructions(spark, sf), SHORT, HELD_OUT, SEED, BATCH)
    return plan.select("split", "batch", "seq_id", _joined("input_ids").alias("input_ids"))


@query
def ngram_perplexity(spark, sf):
    train, held = splits.holdout(_documents(spark, sf), "doc_id", HELD_OUT, SEED)
    return _rounded(flows.ngram_perplexity(train, held), "eval_loss", "perplexity")


@query
def merge_deltas(spark, sf):
    v = _vocab(spark, sf)
    train, held = splits.holdout(_documents(spark, sf), "doc_id", HELD_OUT, SEED)
    base, delta = (bigram.text_pair_counts(df, v, specials=SPECIALS) for df in (train, held))
    path = _folder(spark, "delta")
    bigram.save_delta(delta, path)
    return bigram.load_delta(base, path)


@query
def generate_greedy(spark, sf):
    v, docs = _vocab(spark, sf), _documents(spark, sf)
    model = bigram.text_pair_counts(docs, v, specials=SPECIALS, end=EOS)
    prompts_ = bigram.last_ids(docs, v, ["doc_id"], specials=SPECIALS)
    new = bigram.generate_greedy(prompts_, model, ["doc_id"], vocab.token_id(v, EOS))
    return new.select("doc_id", _joined("generated").alias("generated"))


# --- user functions ---------------------------------------------------------


@query
def map_batches(spark, sf):
    def words(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(n_words=batch["text"].str.count(r"[^ \n\t\r]+"))

    return udfs.map_batches(_documents(spark, sf), words, "doc_id BIGINT, n_words BIGINT", ["text"])


@query
def map_rows(spark, sf):
    def marked(row: dict) -> dict:
        return {"item_id": row["item_id"], "marked": f"{row['item_id']}: {row['text'].replace(' ', '_')}"}

    return udfs.map_rows(_table(spark, sf, "benchmark"), marked, "item_id BIGINT, marked STRING")


@query
def map_fixed_batches(spark, sf):
    def summary(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"first": [batch["doc_id"].iloc[0]], "chars": [batch["n_chars"].sum()]})

    docs = _table(spark, sf, "documents").select("doc_id", "n_chars")
    return udfs.map_fixed_batches(docs, summary, "first BIGINT, chars BIGINT", ["doc_id"], 100)


@query
def custom_loss(spark, sf):
    def squared(x: Column, y: Column) -> Column:
        return F.pow(1 - F.get(x, y).cast("double"), 2)

    rows = batches.assign_batches(_table(spark, sf, "embeddings"), ["vec_id"], BATCH)
    return _rounded(metrics.eval_loss_by_batch(metrics.score(rows, "embedding", "label", squared)), "eval_loss")
