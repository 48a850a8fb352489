import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    """The base spans by the four patterns as they are written down."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1.@-+ 0(2)4é%", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_ordinary_cases():
    text = "é me.x@mail.example.com +1 (988) 555-2485, 1.2.3.4.5, 999.1.1.1, 4532 0151-1283 0366 x@y a@b.c@d.e"
    assert pii.base_spans(text) == plain(text)
    assert [s[0] for s in pii.base_spans(text)] == ["email", "phone", "ip", "card", "email"]


def shown(text):
    base, spans = pii.all_spans(text)
    assert not base
    return [(k, text[s:e]) for k, s, e in spans]


def test_disguises_map_back_to_the_source():
    assert shown("é write jo.doe [at] mail [dot] example (dot) com now") == [("email", "jo.doe [at] mail [dot] example (dot) com")]
    assert shown("write jo at mail dot example dot com.") == [("email", "jo at mail dot example dot com")]
    assert shown("аdam＠mаil．com!") == [("email", "аdam＠mаil．com")]
    assert shown("x​ bo​b@ex­.org​ y")[0] == ("email", "bo​b@ex­.org")
    assert shown("call plus one two three four five six seven eight nine zero ok") == [
        ("phone", "plus one two three four five six seven eight nine zero")
    ]
    assert shown("ip 10 dot 0 dot zero dot one") == [("ip", "10 dot 0 dot zero dot one")]
    assert shown("٤٥٣٢ ٠١٥١ ١٢٨٣ ٠٣٦٦") == [("card", "٤٥٣٢ ٠١٥١ ١٢٨٣ ٠٣٦٦")]


def test_clean_prose_has_no_spans():
    for text in ("look at example.com", "one two three", "meet at the dot", "привет. мир", "", "a one at two dot"):
        assert pii.all_spans(text) == ([], [])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.@ оа１＠​[]dotАt2onetw", max_size=60))
def test_spans_lie_in_the_text_and_base_ones_stay(text):
    base, spans = pii.all_spans(text)
    assert set(base) <= set(spans)
    assert all(0 <= s < e <= len(text) for _, s, e in spans)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "one " * 80_000):
        pii.all_spans(text)


def test_table(spark):
    rows = [(1, "a@b.co x", "x", 1), (None, None, None, None), (1, "a@b.co x", "x", 1), (2, "", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int")
    got = {(r.doc_id, r.n_email, r.spans) for r in pii.find(docs).collect()}
    assert got == {(1, 1, "email:0:6"), (None, 0, ""), (2, 0, "")}
    clean = pii.redact(docs).collect()
    assert sorted((r.doc_id or 0, r.text, r.spans) for r in clean if r.text) == [(1, "[EMAIL] x", "x")] * 2
    assert pii.redact(docs).columns == docs.columns and len(clean) == 4
    assert pii.find(docs.limit(0)).count() == 0


def test_spelled_numbers_end_before_words_that_begin_like_digits():
    number = "plus four nine five five five one two three four five"
    for word in ("Ohio", "ninety", "ones", "sixth", "fourteen"):
        assert shown(f"call {number} {word} now") == [("phone", number)]


def test_disguises_with_dots_in_the_name_and_runs_of_spaces():
    for text in (
        "john at mail.example dot com", "jo  at  mail  dot  example  dot  com", "jo  [ at ]  mail   (dot)  com", "jo at mail  [  dot  ] com",
    ):
        assert shown(f"write {text}.") == [("email", text)]
    number = "plus   one two   three four five six seven eight nine zero"
    assert shown(f"call {number} ok") == [("phone", number)]


def test_address_parts_of_many_digits():
    zeros = "0" * 5_000
    assert pii.base_spans(f"{zeros}.{zeros}1.2.3")[0] == ("ip", 0, 10_006)
    assert pii.base_spans(f"{zeros}.{zeros}256.2.x") == []


def test_long_runs_of_spaces_stay_linear():
    for text in ("a" + " " * 300_000, "one" + " " * 300_000, "[" + " " * 300_000, "a at" + " " * 300_000, "a at " + "b." * 150_000, "a at b  " * 40_000):
        pii.all_spans(text)
