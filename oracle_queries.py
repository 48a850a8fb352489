"""SQL counterparts of the registered queries, in DuckDB's dialect.

They state each result on its own terms (one global window, one global list) and
share nothing with the Spark code but the fixed texts below.
"""

from __future__ import annotations

WORD = r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+"
SPECIALS = ("<unk>", "<bos>", "<eos>")
# The prompt templates and the published 4-bit levels.
H0 = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n### Instruction:\n"
)
H1 = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n### Instruction:\n"
)
NF4 = (
    -1.0, -0.6961928009986877, -0.5250730514526367, -0.39491748809814453, -0.28444138169288635,
    -0.18477343022823334, -0.09105003625154495, 0.0, 0.07958029955625534, 0.16093020141124725,
    0.24611230194568634, 0.33791524171829224, 0.44070982933044434, 0.5626170039176941,
    0.7229568362236023, 1.0,
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DOCS = "SELECT doc_id AS key, text FROM documents"

INSTRUCTIONS = """
ins AS (
  SELECT conv_id * 1000 + turn AS id, text AS instruction, coalesce(sys, '') AS input, reply AS output
  FROM (
    SELECT c.*, lead(text) OVER w AS reply, lead(role) OVER w AS reply_role, sys
    FROM conversations c
    LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS sys FROM conversations WHERE role = 'system' GROUP BY conv_id) s
      USING (conv_id)
    WINDOW w AS (PARTITION BY c.conv_id ORDER BY turn)
  )
  WHERE role = 'user' AND reply_role = 'assistant'
)"""


def prompt(variant: bool = False) -> str:
    gap = "\n\n ### Input:\n" if variant else "\n\n### Input:\n"
    short = "\n\n### Response\n" if variant else "\n\n### Response:\n"
    return (
        f"CASE WHEN input = '' THEN {q(H0)} || instruction || {q(short)} "
        f"ELSE {q(H1)} || instruction || {q(gap)} || input || {q(chr(10) * 2 + '### Response:' + chr(10))} END"
    )


def tokens(name: str, source: str, cols: str = "key") -> str:
    split = f"regexp_extract_all(text, {q(WORD)})"
    return f"{name} AS (SELECT {cols}, unnest({split}) AS token, unnest(range(len({split}))) AS pos FROM ({source}))"


def vocabulary(source: str, specials: tuple[str, ...] = SPECIALS, name: str = "vocab") -> str:
    added = " UNION ALL ".join(
        f"SELECT (SELECT count(*) FROM {name}_n) + {i}, {q(s)}, true" for i, s in enumerate(specials)
    )
    return f"""{tokens(name + "_t", source, "1 AS one")},
{name}_n AS (SELECT token, count(*) AS n FROM {name}_t GROUP BY token),
{name} AS (
  SELECT CAST(id AS INT) AS id, token, special FROM (
    SELECT row_number() OVER (ORDER BY n DESC, token) - 1 AS id, token, false AS special FROM {name}_n
    UNION ALL {added})
)"""


def encoded(source: str, cols: str = "key", name: str = "enc") -> str:
    return f"""{tokens(name + "_t", source, cols)},
{name} AS (
  SELECT {cols}, pos, coalesce(id, {special("<unk>")}) AS id FROM {name}_t LEFT JOIN vocab USING (token)
)"""


def special(token: str) -> str:
    return f"(SELECT id FROM vocab WHERE token = {q(token)})"


def docs_with(*more: str) -> str:
    """WITH clause: vocabulary and ids of the documents, then ``more``."""
    return "WITH " + ",\n".join([vocabulary(DOCS), encoded(DOCS), *more]) + "\n"


def lists(length: str = "len(l)") -> str:
    return f"""ids AS (
  SELECT d.doc_id, coalesce(l, []) AS l, coalesce(len(l), 0) AS n
  FROM documents d LEFT JOIN (SELECT key, list(id ORDER BY pos) AS l FROM enc GROUP BY key) ON key = doc_id)"""


def text_of(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


def stream(keys: str, bos: bool = False, eos: bool = True) -> str:
    marks = ""
    if bos:
        marks += f" UNION ALL SELECT key, -1, {special('<bos>')} FROM ({keys})"
    if eos:
        marks += f" UNION ALL SELECT key, 1000000000, {special('<eos>')} FROM ({keys})"
    return f"""stream AS (
  SELECT id, row_number() OVER (ORDER BY key, pos) - 1 AS o FROM (SELECT key, pos, id FROM enc{marks})
)"""


def disjoint(length: int) -> str:
    chunk = length + 1
    return f"""SELECT o // {chunk} AS seq_id, {text_of(f"list(id ORDER BY o)[1:{length}]")} AS input_ids,
  {text_of(f"list(id ORDER BY o)[2:{chunk}]")} AS labels
FROM stream GROUP BY seq_id HAVING count(*) = {chunk}"""


def overlap(length: int) -> str:
    return f"""SELECT k AS seq_id, {text_of(f"list(id ORDER BY o)[1:{length}]")} AS input_ids,
  {text_of(f"list(id ORDER BY o)[2:{length + 1}]")} AS labels
FROM (SELECT o // {length} AS k, o, id FROM stream
      UNION ALL SELECT o // {length} - 1, o, id FROM stream WHERE o % {length} = 0 AND o > 0)
GROUP BY k HAVING count(*) = {length + 1}"""


def padded(length: int) -> str:
    return f"""chunks AS (
  SELECT o // {length} AS seq_id, list(id ORDER BY o) AS l FROM stream GROUP BY seq_id)"""


def shuffle_key(key: str, epoch: str | None = None) -> str:
    middle = "" if epoch is None else f" || {epoch} || '-'"
    return f"CAST('0x' || substr(md5('42-'{middle} || {key}), 1, 15) AS BIGINT)"


def split_docs(n: int = 50, columns: str = "doc_id, text") -> str:
    key = shuffle_key("doc_id")
    return f"""SELECT {columns}, CASE WHEN row_number() OVER (ORDER BY {key} DESC, doc_id DESC) <= {n}
  THEN 'eval' ELSE 'train' END AS split FROM documents"""


def batched(table: str, key: str, size: int = 8) -> str:
    return f"""batched AS (
  SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS ordinal,
    (row_number() OVER (ORDER BY {key}) - 1) // {size} AS batch FROM {table})"""


def loss(label: str = "label") -> str:
    x = "CAST(embedding AS DOUBLE[])"
    return (
        f"(list_max({x}) + ln(list_sum(list_transform({x}, lambda v: exp(v - list_max({x})))))"
        f" - CAST(embedding[{label} + 1] AS DOUBLE))"
    )


SHARDS = """
shards AS (
  SELECT shard, pos, sum(CAST(x AS DOUBLE)) AS x FROM (
    SELECT CAST(vec_id % 4 AS INT) AS shard, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos
    FROM embeddings) GROUP BY shard, pos)"""


def pairs(source: str, name: str) -> str:
    """Adjacent ids counted: ``source`` has key, pos, id."""
    return f"""{name} AS (
  SELECT prev, next, count(*) AS n FROM (
    SELECT id AS prev, lead(id) OVER (PARTITION BY key ORDER BY pos) AS next FROM ({source}))
  WHERE next IS NOT NULL GROUP BY prev, next)"""


def build() -> dict[str, str]:
    ins = f"WITH {INSTRUCTIONS} "
    sql: dict[str, str] = {}

    sql["instructions"] = ins + "SELECT * FROM ins"
    sql["instructions_from_json"] = ins + "SELECT instruction, input, output FROM ins"
    sql["text_corpus"] = "SELECT doc_id, text FROM documents"
    sql["labelled_text"] = "SELECT doc_id, quality AS label, text FROM documents JOIN labels USING (doc_id)"
    by_split = f"({split_docs()})"
    sql["packed_both_splits"] = " UNION ALL ".join(
        f"SELECT '{s}' AS split, seq_id, input_ids FROM (WITH "
        + ",\n".join(
            [
                vocabulary(DOCS),
                encoded(f"SELECT doc_id AS key, text FROM {by_split} WHERE split = '{s}'"),
                stream(f"SELECT doc_id AS key FROM {by_split} WHERE split = '{s}'"),
            ]
        )
        + f"\nSELECT seq_id, input_ids FROM ({overlap(128)}))"
        for s in ("train", "eval")
    )
    sql["packed_written"] = sql["packed_both_splits"].replace("SELECT seq_id, input_ids FROM", "SELECT seq_id, labels FROM").replace(
        "AS split, seq_id, input_ids", "AS split, seq_id, labels"
    )
    apart = INSTRUCTIONS.replace("conv_id * 1000 + turn", "conv_id * 100000 + turn * 7")
    sql["instructions_with_gaps"] = f"WITH {apart} SELECT * FROM ins"
    sql["instructions_from_array"] = ins + (
        "SELECT row_number() OVER (ORDER BY id) - 1 AS id, "
        "instruction || ' \"}{\\\" [{\"a\": \"\\\\\"}], ' || chr(10) || '}' AS instruction, input, output FROM ins"
    )
    sql["text_splits"] = (
        "SELECT split, text, count(*) AS n FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, "
        "unnest(string_split(text, chr(10))) AS text FROM documents) GROUP BY split, text"
    )
    sql["order_by_timestamp"] = (
        "SELECT l_orderkey, l_linenumber, "
        "row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS ordinal FROM lineitem"
    )
    sql["naive_bayes"] = _naive_bayes(by_split)
    sql["train_pack_plan"] = _train_pack_plan()
    sql["map_rows"] = "SELECT item_id, item_id || ': ' || replace(text, ' ', '_') AS marked FROM benchmark"
    steps = "(SELECT event_id + 1 AS step, value AS loss FROM events)"
    sql["steps_to_save"] = f"SELECT step, loss FROM {steps} WHERE step % 40 = 0 OR step % 500 = 0"
    sql["resume_plan"] = f"SELECT step, loss FROM {steps} WHERE step > (SELECT count(*) * 9 // 10 FROM events)"
    sql["resume_after_empty_state"] = (
        f"SELECT step, loss FROM {steps} WHERE step > (SELECT count(*) * 3 // 4 FROM events)"
    )
    sql["logged_steps"] = f"SELECT step, loss FROM {steps} WHERE step % 5 = 0 OR step = 1"

    sql["count_rows"] = ins + "SELECT count(*) AS rows FROM ins"
    sql["row_at"] = ins + (
        "SELECT *, CAST(32 AS BIGINT) AS ordinal FROM (SELECT * FROM ins ORDER BY id LIMIT 1 OFFSET 32)"
    )
    sql["with_input"] = ins + "SELECT * FROM ins WHERE input <> ''"
    sql["first_with_input"] = ins + "SELECT * FROM ins WHERE input <> '' ORDER BY id LIMIT 1"
    sql["preview"] = ins + "SELECT id, substr(output, 1, 100) AS preview FROM ins"
    sql["rename_and_drop"] = "SELECT doc_id, quality AS labels FROM labels"

    sql["prompt_only"] = ins + f"SELECT id, {prompt()} AS prompt FROM ins"
    sql["prompt_completion"] = ins + (
        f"SELECT id, {prompt()} AS prompt, output || '<eos>' AS output, {prompt()} || output || '<eos>' AS example "
        "FROM ins"
    )
    sql["prompt_full"] = ins + f"SELECT id, {prompt()} || output AS text FROM ins"
    sql["prompt_variant"] = ins + f"SELECT id, {prompt(True)} || output AS text FROM ins"
    user = f"CASE WHEN input = '' THEN instruction ELSE instruction || {q(chr(10) * 2)} || input END"
    helper = "You are a helpful assistant."
    sql["chat_messages"] = ins + (
        f"SELECT id, 0 AS pos, 'system' AS role, {q(helper)} AS content FROM ins "
        f"UNION ALL SELECT id, 1, 'user', {user} FROM ins UNION ALL SELECT id, 2, 'assistant', output FROM ins"
    )

    def turn(role: str, content: str) -> str:
        return f"{q('<|role|>' + role + '<|/role|>' + chr(10) * 2)} || {content} || '<|end|>'"

    chat = (
        f"'<bos>' || {turn('system', q(helper))} || {turn('user', '(' + user + ')')} || {turn('assistant', 'output')}"
    )
    sql["rendered_chat"] = ins + f"SELECT id, {chat} AS text FROM ins"
    sql["tokenized_chat"] = _tokenized_chat(user, helper)

    sql["shuffled"] = (
        f"SELECT doc_id, {shuffle_key('doc_id')} AS shuffle_key, "
        f"row_number() OVER (ORDER BY {shuffle_key('doc_id')}, doc_id) - 1 AS ordinal FROM documents"
    )
    sql["holdout"] = f"SELECT doc_id, split FROM ({split_docs()})"
    sql["holdout_everything"] = "SELECT doc_id, 'eval' AS split FROM documents"
    sql["sample"] = f"SELECT doc_id, lang FROM documents ORDER BY {shuffle_key('doc_id')}, doc_id LIMIT 100"
    sql["epoch_order"] = (
        f"SELECT doc_id, CAST(e AS INT) AS epoch, {shuffle_key('doc_id', 'e')} AS shuffle_key "
        "FROM documents, range(3) r(e)"
    )

    sql["decode_large_vocab"] = "SELECT doc_id, text FROM documents"
    sql["encode_large_vocab"] = docs_with(lists()) + f"SELECT doc_id, {text_of('l')} AS input_ids FROM ids"
    vocab = "WITH " + vocabulary(DOCS) + "\n"
    sql["build_vocab"] = vocab + "SELECT id, token, special FROM vocab"
    sql["vocab_sizes"] = vocab + (
        "SELECT count(*) AS with_added, count(*) FILTER (NOT special) AS without_added FROM vocab"
    )
    sql["encode"] = docs_with(lists()) + f"SELECT doc_id, {text_of('l')} AS input_ids FROM ids"
    sql["encode_unknown"] = (
        "WITH "
        + ",\n".join([vocabulary(DOCS), encoded("SELECT item_id AS key, text FROM benchmark")])
        + f"\nSELECT key AS item_id, {text_of('list(id ORDER BY pos)')} AS input_ids FROM enc GROUP BY key"
    )
    sql["decode_tokens"] = docs_with() + (
        "SELECT key AS doc_id, CAST(pos AS INT) AS pos, id AS token_id, token FROM enc JOIN vocab USING (id)"
    )
    sql["decode"] = "SELECT doc_id, text FROM documents"
    sql["token_count"] = f"SELECT doc_id, CAST(len(regexp_extract_all(text, {q(WORD)})) AS INT) AS n FROM documents"
    marked = f"list_concat([{special('<bos>')}], l, [{special('<eos>')}])"
    sql["with_bos_and_eos"] = docs_with(lists()) + f"SELECT doc_id, {text_of(marked)} AS input_ids FROM ids"
    sql["special_tokens_map"] = vocab + (
        "SELECT role, token, id FROM (VALUES ('bos', '<bos>'), ('eos', '<eos>'), ('pad', '<eos>'), ('unk', '<unk>')) "
        "r(role, token) LEFT JOIN vocab USING (token)"
    )
    sql["added_tokens"] = vocab + "SELECT id, token FROM vocab WHERE special"
    reserved = tuple(f"<reserved_special_token_{i}>" for i in range(8))
    sql["reserved_tokens"] = (
        "WITH " + vocabulary(DOCS, (*SPECIALS, *reserved)) + "\n"
        "SELECT id, token FROM vocab WHERE special AND contains(token, 'reserved_special_token')"
    )
    sql["rename_token"] = vocab + (
        "SELECT id, CASE WHEN token = '<bos>' THEN '<tool_call>' ELSE token END AS token, special FROM vocab"
    )
    sql["add_tokens"] = vocab + (
        "SELECT id, token, special FROM vocab UNION ALL "
        "SELECT CAST((SELECT max(id) FROM vocab) + i AS INT), t, true "
        "FROM (VALUES (1, '<TIME>'), (2, '<DATE>'), (3, '<LOCATION>')) a(i, t)"
    )
    sql["token_lookup"] = (
        "WITH " + vocabulary(DOCS) + ",\n" + tokens("b", "SELECT item_id AS key, text FROM benchmark") + "\n"
        "SELECT DISTINCT token, id FROM b LEFT JOIN vocab USING (token)"
    )
    sql["resized_values"] = vocab + (
        "SELECT id, coalesce((SELECT array_to_string(list_transform(embedding, "
        "lambda x: CAST(round(CAST(x AS DOUBLE), 6) AS DECIMAL(12, 6))), ',') FROM embeddings WHERE vec_id = id), 'new') AS vec "
        "FROM vocab"
    )
    sql["resize_embeddings"] = vocab + "SELECT id, 64 AS width FROM vocab"
    gaps = "SELECT doc_id AS key, unnest(string_split(text, ',')) AS text, unnest(range(len(string_split(text, ',')))) AS g FROM documents"
    sql["encode_added"] = (
        "WITH "
        + ",\n".join([vocabulary(DOCS), encoded(gaps, "key, g")])
        + f""",
seps AS (SELECT key, g, 1000000000 AS pos, (SELECT max(id) + 1 FROM vocab) AS id
  FROM (SELECT key, g, max(g) OVER (PARTITION BY key) AS top FROM ({gaps})) WHERE g < top),
ids AS (SELECT key, list(id ORDER BY g, pos) AS l FROM (SELECT * FROM enc UNION ALL SELECT * FROM seps) GROUP BY key)
SELECT doc_id, {text_of("coalesce(l, [])")} AS input_ids FROM documents LEFT JOIN ids ON key = doc_id"""
    )
    sql["decode_generated"] = ins + "SELECT id, output AS text FROM ins"

    eos = special("<eos>")
    fill = f"list_transform(range(greatest(0, 64 - n)), lambda i: {{}})"
    pad, zeros, ones = fill.format("e.id"), fill.format("0"), "list_transform(range(n), lambda i: 1)"
    from_ids = f"FROM ids, (SELECT id FROM vocab WHERE token = '<eos>') e"
    sql["pad_right"] = docs_with(lists()) + (
        f"SELECT doc_id, {text_of(f'list_concat(l, {pad})')} AS input_ids, "
        f"{text_of(f'list_concat({ones}, {zeros})')} AS attention_mask {from_ids}"
    )
    sql["pad_left"] = docs_with(lists()) + (
        f"SELECT doc_id, {text_of(f'list_concat({pad}, l)')} AS input_ids, "
        f"{text_of(f'list_concat({zeros}, {ones})')} AS attention_mask {from_ids}"
    )
    sql["truncate"] = docs_with(lists()) + f"SELECT doc_id, {text_of('l[1:64]')} AS input_ids FROM ids"
    sql["pad_and_truncate"] = docs_with(lists()) + (
        f"SELECT doc_id, {text_of(f'list_concat(l, {pad})[1:64]')} AS input_ids, "
        f"{text_of(f'list_concat({ones}, {zeros})[1:64]')} AS attention_mask {from_ids}"
    )
    sql["next_token_pairs"] = docs_with() + (
        "SELECT key AS doc_id, CAST(pos AS INT) AS step, id AS input, next AS label FROM "
        "(SELECT *, lead(id) OVER (PARTITION BY key ORDER BY pos) AS next FROM enc) WHERE next IS NOT NULL"
    )
    n = f"len(regexp_extract_all(text, {q(WORD)}))"
    sql["padding_waste"] = (
        f"SELECT count(*) AS rows, count(*) * 128 AS total_tokens, CAST(sum(128 - {n}) AS BIGINT) AS pad_tokens, "
        f"round(sum(128 - {n}) * 100.0 / (count(*) * 128), 6) AS pad_percent FROM documents"
    )
    keys = "SELECT doc_id AS key FROM documents"
    sql["layout"] = docs_with(stream(keys), padded(20)) + (
        f"SELECT seq_id, rpad(array_to_string(list_transform(l, lambda t: CASE WHEN t = e.id THEN '|' ELSE 'T' END), ''),"
        f" 20, '|') AS layout FROM chunks, (SELECT id FROM vocab WHERE token = '<eos>') e"
    )
    sql["sample_layout"] = (
        f"SELECT doc_id, repeat('T', {n}) || repeat('_', greatest(128 - {n}, 0)) AS layout FROM documents"
    )
    sql["pack_disjoint"] = docs_with(stream(keys, bos=True)) + disjoint(128)
    sql["pack_disjoint_plain"] = docs_with(stream(keys, eos=False)) + disjoint(15)
    sql["pack_overlap"] = docs_with(stream(keys)) + overlap(128)
    sql["pack_overlap_large_vocab"] = sql["pack_overlap"]
    prompts = f"SELECT id AS key, {prompt()} || output AS text FROM ins"
    sql["pack_constant_length"] = (
        "WITH "
        + ",\n".join([INSTRUCTIONS, vocabulary(prompts), encoded(prompts), stream("SELECT id AS key FROM ins")])
        + "\n"
        + overlap(64)
    )
    sql["pack_padded"] = docs_with(stream(keys), padded(20)) + (
        f"SELECT seq_id, {text_of('list_resize(l, 20, e.id)')} AS input_ids, CAST(len(l) AS INT) AS real "
        "FROM chunks, (SELECT id FROM vocab WHERE token = '<eos>') e"
    )
    sql["group_texts"] = docs_with(_batches_of_texts()) + f"""
SELECT worker, batch, o // 128 AS block, {text_of("list(id ORDER BY o)")} AS input_ids,
  {text_of("list(1 ORDER BY o)")} AS attention_mask, {text_of("list(id ORDER BY o)")} AS labels
FROM placed GROUP BY worker, batch, block HAVING count(*) = 128"""
    sql["packing_report"] = f"""
SELECT total_before, pad_before, real_tokens, sequences, sequences * 128 AS total_after,
  sequences * 128 - real_tokens AS pad_after, round(pad_before * 100.0 / total_before, 6) AS percent_before,
  round((sequences * 128 - real_tokens) * 100.0 / (sequences * 128), 6) AS percent_after
FROM (SELECT count(*) * 128 AS total_before, CAST(sum(128 - {n}) AS BIGINT) AS pad_before,
  CAST(sum({n} + 1) AS BIGINT) AS real_tokens,
  CAST((sum({n} + 1) + 127) // 128 AS BIGINT) AS sequences FROM documents)"""

    docs8 = f"WITH {batched('(SELECT doc_id, n_chars FROM documents)', 'doc_id')} "
    sql["assign_batches"] = docs8 + "SELECT doc_id, n_chars, ordinal, batch FROM batched"
    sql["collate"] = docs8 + f"SELECT batch, {text_of('list(doc_id ORDER BY ordinal)')} AS doc_ids FROM batched GROUP BY batch"
    sql["shard_by_rank"] = docs8 + "SELECT doc_id, batch, CAST(batch % 4 AS INT) AS rank FROM batched"
    steps_of = "FROM (SELECT DISTINCT batch AS step FROM batched), range(3) r(epoch), (SELECT count(*) AS rows FROM documents)"
    per = "((rows + 7) // 8)"
    sql["updates_vanilla"] = docs8 + (
        f"SELECT step, epoch, u AS update, u < 3 * (({per} + 3) // 4) AS applied FROM "
        f"(SELECT *, epoch * (({per} + 3) // 4) + (step + 3) // 4 AS u {steps_of})"
    )
    sql["updates_accelerate"] = docs8 + (
        f"SELECT step, epoch, epoch * (({per} + 7) // 8) + step // 8 AS update, true AS applied {steps_of}"
    )
    sql["updates_pipeline"] = docs8 + (
        "SELECT step, epoch, CASE WHEN step // 8 < rows // 64 THEN epoch * (rows // 64) + step // 8 END AS update, "
        f"step // 8 < rows // 64 AS applied {steps_of}"
    )
    sql["plan_summary"] = """
SELECT n AS examples, b AS batches, total AS total_steps,
  CASE WHEN mode = 'raw' THEN 0 ELSE total // 10 END AS warmup_steps, CAST(256 AS BIGINT) AS effective_batch, mode
FROM (SELECT n, b, mode, CASE mode WHEN 'vanilla' THEN 3 * b // 8 WHEN 'accelerate' THEN 3 * (b // 8)
    WHEN 'pipeline' THEN 3 * (n // 64) ELSE 3 * b END AS total
  FROM (SELECT count(*) AS n, (count(*) + 7) // 8 AS b FROM documents),
    (VALUES ('vanilla'), ('accelerate'), ('pipeline'), ('raw')) m(mode))"""
    sql["shard_by_weight"] = """
SELECT doc_id, n_chars, CAST(before AS BIGINT) AS before,
  CAST(least(3, floor(4.0::DOUBLE * before / (SELECT sum(n_chars) FROM documents))) AS INT) AS shard
FROM (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY doc_id) - n_chars AS before FROM documents)"""

    vec8 = f"WITH {batched('embeddings', 'vec_id')} "
    sql["cross_entropy"] = f"SELECT vec_id, round({loss()}, 6) AS loss FROM embeddings"
    sql["cross_entropy_ignored"] = (
        f"SELECT count(*) AS rows, round(avg({loss()}), 6) AS loss FROM embeddings WHERE label <> 0"
    )
    means = f"SELECT batch, avg({loss()}) AS m FROM batched GROUP BY batch"
    sql["eval_loss_by_batch"] = vec8 + f"SELECT round(avg(m), 6) AS eval_loss FROM ({means})"
    sql["eval_loss_reduced"] = vec8 + (
        f"SELECT round(sum(m), 6) AS total_loss, count(*) AS total_steps, round(sum(m) / count(*), 6) AS eval_loss FROM ({means})"
    )
    sql["perplexity"] = vec8 + f"SELECT round(exp(avg(m)), 2) AS perplexity FROM ({means})"
    first = "CAST(list_position(embedding, list_max(embedding)) - 1 AS INT)"
    sql["argmax"] = f"SELECT vec_id, {first} AS prediction FROM embeddings"
    sql["accuracy"] = (
        f"SELECT count(*) FILTER ({first} = label) AS correct, count(*) AS total, "
        f"round(count(*) FILTER ({first} = label) / count(*), 6) AS accuracy FROM embeddings"
    )

    sh = f"WITH {SHARDS} "
    others = "(SELECT DISTINCT shard FROM shards)"
    sql["broadcast_vector"] = sh + (
        f"SELECT o.shard, CAST(pos AS INT) AS pos, round(x, 6) AS x FROM {others} o, shards s WHERE s.shard = 0"
    )
    sql["vector_sum"] = sh + "SELECT CAST(pos AS INT) AS pos, round(sum(x), 6) AS x FROM shards GROUP BY pos"
    sql["vector_sum_all"] = sh + (
        "SELECT o.shard, CAST(pos AS INT) AS pos, round(x, 6) AS x "
        f"FROM {others} o, (SELECT pos, sum(x) AS x FROM shards GROUP BY pos)"
    )
    items = "CAST(shard AS INT) AS item, CAST(pos AS INT) AS pos, round(x, 6) AS x"
    sql["gather_vectors"] = sh + f"SELECT {items} FROM shards"
    sql["gather_vectors_all"] = sh + (
        f"SELECT o.shard, CAST(s.shard AS INT) AS item, CAST(pos AS INT) AS pos, round(x, 6) AS x FROM {others} o, shards s"
    )
    sql["scatter_vectors"] = sh + "SELECT shard, CAST(pos AS INT) AS pos, round(x, 6) AS x FROM shards"
    sql["segment_sum"] = sh + (
        "SELECT CAST(pos // 16 AS INT) AS shard, CAST(pos % 16 AS INT) AS pos, round(sum(x), 6) AS x "
        "FROM shards GROUP BY ALL"
    )
    middles = "[" + ", ".join(repr((a + b) / 2) + "::DOUBLE" for a, b in zip(NF4, NF4[1:])) + "]"
    sql["quantize_vectors"] = f"""
SELECT vec_id, CAST(b AS INT) AS block, round(s, 6) AS scale,
  array_to_string(list_transform(x, lambda v: len(list_filter({middles}, lambda m: m < v / s))), ',') AS codes
FROM (SELECT vec_id, b, x, list_max(list_transform(x, lambda v: abs(v))) AS s
  FROM (SELECT vec_id, b, CAST(embedding[b * 16 + 1 : b * 16 + 16] AS DOUBLE[]) AS x FROM embeddings, range(4) r(b)))"""

    levels = "[" + ", ".join(repr(v) + "::DOUBLE" for v in NF4) + "]"
    code = f"len(list_filter({middles}, lambda m: m < x[p] / s))"
    sql["dequantize_vectors"] = f"""
SELECT vec_id, CAST(b * 16 + p - 1 AS INT) AS pos, round(CAST(CAST({levels}[{code} + 1] * s AS FLOAT) AS DOUBLE), 6) AS x
FROM (SELECT vec_id, b, x, list_max(list_transform(x, lambda v: abs(v))) AS s, unnest(range(1, 17)) AS p
  FROM (SELECT vec_id, b, CAST(embedding[b * 16 + 1 : b * 16 + 16] AS DOUBLE[]) AS x FROM embeddings, range(4) r(b)))"""

    held = f"SELECT doc_id AS key, text FROM {by_split} WHERE split = 'eval'"
    train = f"SELECT doc_id AS key, text FROM {by_split} WHERE split = 'train'"
    sql["ngram_perplexity"] = (
        "WITH "
        + ",\n".join(
            [
                vocabulary(train),
                encoded(train, name="a"),
                encoded(held, name="b"),
                pairs("SELECT * FROM a", "model"),
                pairs("SELECT * FROM b", "seen"),
                "ctx AS (SELECT prev, sum(n) AS pn FROM model GROUP BY prev)",
            ]
        )
        + """
SELECT CAST(sum(n) AS BIGINT) AS tokens, round(sum(nll * n) / sum(n), 6) AS eval_loss, round(exp(sum(nll * n) / sum(n)), 6) AS perplexity
FROM (SELECT s.n, -ln((coalesce(m.n, 0) + 1) / (coalesce(pn, 0) + (SELECT count(*) FROM vocab))::DOUBLE) AS nll
  FROM seen s LEFT JOIN model m USING (prev, next) LEFT JOIN ctx USING (prev))"""
    )
    sql["merge_deltas"] = docs_with(pairs("SELECT * FROM enc", "model")) + "SELECT prev, next, n FROM model"
    closed = f"SELECT key, pos, id FROM enc UNION ALL SELECT doc_id, 1000000000, {eos} FROM documents"
    sql["generate_greedy"] = "WITH RECURSIVE " + docs_with(pairs(closed, "model"))[5:].rstrip() + f""",
best AS (
  SELECT prev, next FROM model WHERE prev <> {eos}
  QUALIFY row_number() OVER (PARTITION BY prev ORDER BY n DESC, next) = 1),
prompt AS (SELECT key, arg_max(id, pos) AS cur FROM enc GROUP BY key),
walk AS (
  SELECT key, 0 AS step, cur FROM prompt
  UNION ALL SELECT key, step + 1, next FROM walk JOIN best ON prev = cur WHERE step < 80)
SELECT doc_id, coalesce(array_to_string(g, ','), '') AS generated
FROM documents LEFT JOIN (SELECT key, list(cur ORDER BY step) AS g FROM walk WHERE step > 0 GROUP BY key) ON key = doc_id"""

    sql |= _round_three(user, helper, n, keys, by_split, middles)
    sql["collate_with_hook"] = f"WITH {batched('documents', 'doc_id')} " + (
        "SELECT batch, max(n_chars) AS longest FROM batched GROUP BY batch"
    )
    sql["map_batches"] = (
        r"SELECT doc_id, len(regexp_extract_all(text, '[^ \n\t\r]+')) AS n_words FROM documents"
    )
    sql["map_fixed_batches"] = f"WITH {batched('documents', 'doc_id', 100)} " + (
        "SELECT min(doc_id) AS first, CAST(sum(n_chars) AS BIGINT) AS chars FROM batched GROUP BY batch"
    )
    sql["custom_loss"] = vec8 + (
        "SELECT round(avg(m), 6) AS eval_loss FROM "
        "(SELECT batch, avg(pow(1 - CAST(embedding[label + 1] AS DOUBLE), 2)) AS m FROM batched GROUP BY batch)"
    )
    return sql


def _round_three(user: str, helper: str, n: str, keys: str, by_split: str, middles: str) -> dict[str, str]:
    sql: dict[str, str] = {}
    ins = f"WITH {INSTRUCTIONS} "
    said = [("system", q(helper)), ("user", f"({user})"), ("assistant", "output")]
    im = " || ".join(f"'<|im_start|>{r}' || chr(10) || {c} || '<|im_end|>' || chr(10)" for r, c in said)
    sql["template_chatml"] = ins + f"SELECT id, {im} AS text FROM ins"
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    heads = " || ".join(
        f"'<|start_header_id|>{r}<|end_header_id|>' || chr(10) || chr(10) || trim({c}, {white}) || '<|eot_id|>'" for r, c in said
    )
    sql["template_headers"] = ins + f"SELECT id, '<bos>' || {heads} AS text FROM ins"
    roles = " || ".join(f"'<|{r}|>' || chr(10) || {c} || '<eos>' || chr(10)" for r, c in said[:2])
    sql["template_by_role"] = ins + f"SELECT id, {roles} || '<|assistant|>' || chr(10) AS text FROM ins"

    def digits(turn: int, half: str) -> str:
        return f"CAST('0x' || substr(md5('42-' || epoch || '-{turn}-' || {half}), 1, 12) AS BIGINT)"

    step = "SELECT doc_id, epoch, n, wide, high, turn, x // wide AS l, x % wide AS r FROM walk WHERE turn = 0 OR x >= n"
    for turn in range(4):
        moved = f"l, (r + {digits(turn, 'l')}) % wide AS r" if turn % 2 == 0 else f"(l + {digits(turn, 'r')}) % high AS l, r"
        step = f"SELECT doc_id, epoch, n, wide, high, turn, {moved} FROM ({step})"
    walk = f"""WITH RECURSIVE size AS (
  SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS wide FROM documents
), walk AS (
  SELECT doc_id, CAST(e AS INT) AS epoch, n, wide, (n + wide - 1) // wide AS high, 0 AS turn,
    row_number() OVER (PARTITION BY e ORDER BY doc_id) - 1 AS x FROM documents, size, range(3) r(e)
  UNION ALL SELECT doc_id, epoch, n, wide, high, turn + 1, l * wide + r FROM ({step})
) """
    sql["epoch_places"] = walk + "SELECT doc_id, epoch, x AS place FROM walk WHERE turn > 0 AND x < n"
    sql["resume_inside_epoch"] = walk + (
        "SELECT x AS place, doc_id FROM walk WHERE turn > 0 AND x < n AND epoch = 1 AND x >= n * 3 // 5"
    )

    # Best fit, sample by sample: what is left in each bin is a list.
    fitted = f"""items AS (
  SELECT doc_id, n, row_number() OVER (ORDER BY n DESC, doc_id) AS i
  FROM (SELECT doc_id, least(128, {n})::INT AS n FROM documents) WHERE n > 0
), fill AS (
  SELECT 0 AS i, CAST([] AS INT[]) AS bins, CAST(0 AS BIGINT) AS bin
  UNION ALL
  SELECT i, CASE WHEN pos > len(bins) THEN list_append(bins, 128 - n)
    ELSE list_concat(list_append(bins[1:pos - 1], bins[pos] - n), bins[pos + 1:]) END, pos - 1
  FROM (SELECT items.i, n, bins, coalesce(list_position(bins, list_min(list_filter(bins, lambda x: x >= n))), len(bins) + 1) AS pos
    FROM fill JOIN items ON items.i = fill.i + 1)
), binned AS (SELECT doc_id, n, i, bin FROM items JOIN fill USING (i))"""
    sql["pack_best_fit"] = "WITH RECURSIVE " + docs_with(lists(), fitted)[5:] + f"""
SELECT bin AS seq_id, {text_of("list_resize(flatten(list(l[1:128] ORDER BY i)), 128, any_value(e.id))")} AS input_ids,
  {text_of("list(b.n ORDER BY i)")} AS lengths, {text_of("list(doc_id ORDER BY i)")} AS keys, CAST(sum(b.n) AS INT) AS real
FROM binned b JOIN ids USING (doc_id), (SELECT id FROM vocab WHERE token = '<eos>') e GROUP BY bin"""
    sql["best_fit_report"] = f"WITH RECURSIVE {fitted}" + """
SELECT max(bin) + 1 AS sequences, CAST(sum(n) AS BIGINT) AS tokens, CAST((max(bin) + 1) * 128 - sum(n) AS BIGINT) AS pad_tokens,
  round(((max(bin) + 1) * 128 - sum(n)) * 100.0 / ((max(bin) + 1) * 128), 6) AS pad_percent FROM binned"""

    cuts = ", ".join(
        f"LATERAL (SELECT coalesce(max(e), 0) AS c{k} FROM p WHERE e <= {f'c{k - 1} + ' if k > 1 else ''}mid) x{k}" for k in range(1, 5)
    )
    sql["shard_by_least_weight"] = f"""
WITH RECURSIVE p AS (
  SELECT doc_id, n_chars, CAST(sum(n_chars) OVER (ORDER BY doc_id) AS BIGINT) AS e FROM documents
), search AS (
  SELECT max(n_chars) AS lo, max(e) AS hi, max(e) AS total FROM p
  UNION ALL
  SELECT CASE WHEN c4 >= total THEN lo ELSE mid + 1 END, CASE WHEN c4 >= total THEN mid ELSE hi END, total
  FROM (SELECT lo, hi, total, (lo + hi) // 2 AS mid FROM search WHERE lo < hi) s, {cuts}
), least_ AS (SELECT lo AS mid FROM search WHERE lo = hi LIMIT 1),
ends AS (SELECT c1, c2, c3, c4 FROM least_, {cuts})
SELECT doc_id, n_chars, CAST((c1 < e)::INT + (c2 < e)::INT + (c3 < e)::INT AS INT) AS shard FROM p, ends"""

    each = f"SELECT CAST(floor(sqrt(vec_id)) AS BIGINT) AS seq, vec_id % 5 <> 0 AS counts, {loss()} AS v FROM embeddings"
    sql["sequence_loss"] = (
        f"SELECT seq, round(coalesce(sum(v) FILTER (counts), 0), 6) AS loss, count(*) FILTER (counts) AS count FROM ({each}) GROUP BY seq"
    )
    sql["sequence_eval_loss"] = f"SELECT count(*) AS positions, round(avg(v), 6) AS eval_loss FROM ({each}) WHERE counts"

    scaled = """WITH scales AS (
  SELECT vec_id, b, list_max(list_transform(CAST(embedding[b * 16 + 1 : b * 16 + 16] AS DOUBLE[]), lambda v: abs(v))) AS s,
    ((row_number() OVER (PARTITION BY b ORDER BY vec_id) - 1) * 4 + b) // 256 AS g
  FROM embeddings, range(4) r(b)
), mean AS (SELECT round(avg(s), 6) AS mean FROM scales),
coded AS (
  SELECT vec_id, b, mean, far, CAST(round(coalesce((s - mean) / nullif(far, 0), 0) * 127) AS INT) AS code
  FROM (SELECT *, max(abs(s - mean)) OVER (PARTITION BY g) AS far FROM scales, mean)
) """
    sql["quantize_scales"] = scaled + "SELECT vec_id, CAST(b AS INT) AS block, code FROM coded"
    sql["dequantize_scales"] = scaled + (
        "SELECT vec_id, CAST(b AS INT) AS block, round(code / 127.0::DOUBLE * far + mean, 6) AS scale FROM coded"
    )

    sql["classifier_accuracy"] = f"""
WITH RECURSIVE labelled AS (
  SELECT doc_id, quality AS y, split, regexp_extract_all(text, {q(WORD)}) AS w FROM ({split_docs()}) JOIN labels USING (doc_id)
), marked AS (
  SELECT doc_id, y, row_number() OVER (ORDER BY {shuffle_key("doc_id")} DESC, doc_id DESC) <= 50 AS held,
    list_filter(list_transform(labelled.w, lambda t: lower(trim(t))), lambda t: t <> '') AS words FROM labelled
), cells AS (
  SELECT doc_id, cell, count(*) / any_value(size) AS v
  FROM (SELECT doc_id, len(words) AS size, CAST('0x' || substr(md5(unnest(words)), 1, 6) AS BIGINT) % 256 AS cell FROM marked)
  GROUP BY doc_id, cell
  UNION ALL SELECT doc_id, 256, 1 FROM marked
), train AS (SELECT doc_id, y, cell, v FROM marked JOIN cells USING (doc_id) WHERE NOT held),
size AS (SELECT count(*) AS n FROM marked WHERE NOT held),
fit AS (
  SELECT 0 AS t, list_transform(range(257), lambda i: 0.0::DOUBLE) AS w
  UNION ALL
  SELECT t + 1, list(nw ORDER BY cell) FROM (
    SELECT t, all_cells.cell, any_value(w)[all_cells.cell + 1] - 20 * coalesce(sum(off * v), 0) / any_value(n) AS nw
    FROM range(257) all_cells(cell) LEFT JOIN train USING (cell)
    LEFT JOIN (
      SELECT doc_id, 1 / (1 + exp(-sum(w[cell + 1] * v))) - any_value(y) AS off
      FROM train, fit GROUP BY doc_id
    ) USING (doc_id), fit, size WHERE t < 10 GROUP BY t, all_cells.cell
  ) GROUP BY t
), scored AS (
  SELECT doc_id, any_value(y) AS y, round(sum(w[cell + 1] * v), 9) > 0 AS hit
  FROM marked JOIN cells USING (doc_id), (SELECT w FROM fit WHERE t = 10) WHERE held GROUP BY doc_id
)
SELECT count(*) FILTER (hit = (y = 1)) AS correct, count(*) AS total,
  round(count(*) FILTER (hit = (y = 1)) / count(*), 6) AS accuracy FROM scored"""
    whole = docs_with(stream(keys)) + f"SELECT seq_id, input_ids FROM ({overlap(128)})"
    sql["stored_share"] = f"""
SELECT seq_id, input_ids FROM ({whole}), (SELECT count(*) AS n FROM ({whole}))
WHERE seq_id >= 500 + (n - 500 + 3) // 4 AND seq_id < 500 + 2 * ((n - 500 + 3) // 4)"""
    return sql


def _naive_bayes(by_split: str) -> str:
    labelled = """(SELECT doc_id, quality AS label, text,
  row_number() OVER (ORDER BY {key} DESC, doc_id DESC) <= 50 AS held
FROM documents JOIN labels USING (doc_id))""".format(key=shuffle_key("doc_id"))
    return f"""
WITH rows AS (SELECT * FROM {labelled}),
words AS (SELECT doc_id, label, held, lower(trim(unnest(regexp_extract_all(text, {q(WORD)})))) AS token FROM rows),
counts AS (SELECT token, label, count(*) AS n FROM words WHERE NOT held GROUP BY ALL),
size AS (SELECT count(DISTINCT token) AS v FROM counts),
classes AS (
  SELECT label AS c, docs, tokens, docs / sum(docs) OVER () AS share
  FROM (SELECT label, count(*) AS docs FROM rows WHERE NOT held GROUP BY label)
  JOIN (SELECT label, sum(n) AS tokens FROM counts GROUP BY label) USING (label)),
terms AS (
  SELECT doc_id, c, sum(ln(coalesce(n, 0) + 1)) AS logs, count(*) AS length
  FROM (SELECT doc_id, token, c FROM words, classes WHERE held) w
  LEFT JOIN counts ON counts.token = w.token AND counts.label = w.c GROUP BY doc_id, c),
scores AS (
  SELECT r.doc_id, r.label, c, round(ln(share) + coalesce(logs, 0) - coalesce(length, 0) * ln(tokens + v), 9) AS score
  FROM (SELECT doc_id, label, c, share, tokens, v FROM rows, classes, size WHERE held) r LEFT JOIN terms USING (doc_id, c))
SELECT doc_id, label, CAST(c AS INT) AS prediction FROM scores
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, c) = 1"""


def _train_pack_plan() -> str:
    """Each split's prompts in the order of (shuffle key, id), written as one sortable text key."""
    key = f"lpad(CAST({shuffle_key('id')} AS VARCHAR), 19, '0') || '-' || lpad(CAST(id AS VARCHAR), 19, '0')"
    texts = f"SELECT {key} AS key, {prompt()} || output AS text FROM ins"
    split = f"SELECT *, row_number() OVER (ORDER BY key DESC) <= 50 AS held FROM ({texts})"
    each = []
    for name, chosen in (("train", "NOT held"), ("eval", "held")):
        part = f"SELECT key, text FROM ({split}) WHERE {chosen}"
        parts = [INSTRUCTIONS, vocabulary(texts), encoded(part), stream(f"SELECT key FROM ({part})")]
        each.append(
            f"SELECT '{name}' AS split, seq_id // 8 AS batch, seq_id, input_ids FROM (WITH "
            + ",\n".join(parts)
            + f"\nSELECT seq_id, input_ids FROM ({overlap(64)}))"
        )
    return " UNION ALL ".join(each)


def _tokenized_chat(user: str, helper: str) -> str:
    """Chats as a list of literal pieces, so that special tokens are known by position."""
    specials = ("<unk>", "<bos>", "<eos>", "<|role|>", "<|/role|>", "<|end|>")
    pieces = [("'<bos>'", True)]
    for role, content in (("system", q(helper)), ("user", f"({user})"), ("assistant", "output")):
        gap = q(chr(10) * 2)
        pieces += [("'<|role|>'", True), (q(role), False), ("'<|/role|>'", True)]
        pieces += [(f"{gap} || {content}", False), ("'<|end|>'", True)]
    rows = " UNION ALL ".join(
        f"SELECT id AS key, {i} AS g, {t} AS text, {str(s).lower()} AS mark FROM ins" for i, (t, s) in enumerate(pieces)
    )
    texts = "SELECT key, g, text FROM parts WHERE NOT mark"
    return (
        "WITH "
        + ",\n".join(
            [INSTRUCTIONS, f"parts AS ({rows})", vocabulary(texts, specials), tokens("words", texts, "key, g")]
        )
        + """,
line AS (
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY g, pos) - 1 AS pos, token FROM (
    SELECT key, g, pos, token FROM words UNION ALL SELECT key, g, 0, text FROM parts WHERE mark))
SELECT key AS id, CAST(pos AS INT) AS pos, vocab.id AS token_id, token
FROM line JOIN vocab USING (token) WHERE pos < 15"""
    )


def _batches_of_texts() -> str:
    return """shares AS (
  SELECT w AS worker, w * (n // 4) + least(w, n % 4) AS first, n // 4 + CASE WHEN w < n % 4 THEN 1 ELSE 0 END AS size
  FROM (SELECT count(*) AS n FROM documents), range(4) r(w)),
dealt AS (
  SELECT doc_id AS key, worker, (o - first) // 100 AS batch
  FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o FROM documents), shares
  WHERE o >= first AND o < first + size),
placed AS (
  SELECT worker, batch, id, row_number() OVER (PARTITION BY worker, batch ORDER BY key, pos) - 1 AS o
  FROM enc JOIN dealt USING (key))"""
