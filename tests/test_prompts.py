from pyspark.sql import functions as F

from tokenloom.functions import prompts

ROWS = [
    (1, "Add.", "2 {x} %s", "4"),
    (2, "Sing.", "", "la {input}"),
    (3, "Sing.", None, ""),
]
SCHEMA = "id INT, instruction STRING, input STRING, output STRING"


def texts(spark, column):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return {r.id: r.t for r in df.select("id", column.alias("t")).collect()}


def test_prompt_templates_are_exact(spark):
    got = texts(spark, prompts.prompt_only())
    assert got[1] == (
        "Below is an instruction that describes a task, paired with an input that provides further context. "
        "Write a response that appropriately completes the request.\n\n"
        "### Instruction:\nAdd.\n\n### Input:\n2 {x} %s\n\n### Response:\n"
    )
    assert got[2] == got[3] == (
        "Below is an instruction that describes a task. "
        "Write a response that appropriately completes the request.\n\n"
        "### Instruction:\nSing.\n\n### Response:\n"
    )


def test_full_prompt_ends_with_the_output(spark):
    short, full = texts(spark, prompts.prompt_only()), texts(spark, prompts.prompt_full())
    assert full == {i: short[i] + o for i, _, _, o in ROWS}


def test_variant_keeps_its_irregularities(spark):
    got = texts(spark, prompts.prompt_full(variant=True))
    assert got[2].endswith("### Instruction:\nSing.\n\n### Response\nla {input}")
    assert got[1].endswith("Add.\n\n ### Input:\n2 {x} %s\n\n### Response:\n4")


def test_completion_appends_the_end_token(spark):
    assert texts(spark, prompts.completion(eos="</s>")) == {1: "4</s>", 2: "la {input}</s>", 3: "</s>"}


def test_messages_and_chat(spark):
    got = texts(spark, prompts.to_messages())
    assert [tuple(m) for m in got[1]] == [
        ("system", "You are a helpful assistant."),
        ("user", "Add.\n\n2 {x} %s"),
        ("assistant", "4"),
    ]
    assert got[3][1]["content"] == "Sing."
    template = prompts.ChatTemplate("<s>", "[", "]", ".")
    chat = texts(spark, prompts.render_chat(prompts.to_messages(), template))
    assert chat[2] == "<s>[system]You are a helpful assistant..[user]Sing..[assistant]la {input}."


def test_has_input(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).filter(prompts.has_input())
    assert [r.id for r in df.select(F.col("id")).collect()] == [1]
