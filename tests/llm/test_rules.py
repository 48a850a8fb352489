import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")

def prose(n):
    return " ".join(f"w{i} x{i} y{i} z{i} v{i}." for i in range(n))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t|#é ", max_size=80))
def test_base_measures_equal_their_definitions(text):
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    got = rules.judge(text)
    assert got[:5] == (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )
    assert got[5] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_large_vocabularies_use_exact_windows():
    numbers = rules._Numbers({str(i).encode(): i for i in range(1 << 21)})
    assert rules.repeated_words(b"a b c a b c d".split(), numbers) == 6


def test_lines_that_fail_and_lines_that_stay():
    fails = lambda line: rules.line_fails(line.encode(), line.encode().split())
    assert fails("Home | News | Sport | About")
    assert fails("BUY!! NOW!! CHEAP!!")
    assert fails("no mark at all in here")
    assert fails("word word word word word word word word.")
    assert fails("All rights reserved.")
    assert not fails("A short title")
    assert not fails("An ordinary sentence, with an end.")
    assert not fails("token = x; done.")


def test_documents_are_rejected_for_what_they_lose(spark):
    good, bars = prose(20), "\n" + " | ".join(f"n{i}" for i in range(40))
    rows = [
        (1, good, "e", 7), (2, good + bars, "e", 7), (3, prose(10) + bars * 4, "e", 7), (4, None, None, None),
        (5, "", "e", 0), (1, good, "e", 7), (None, good, "e", 7), (6, prose(30_000), "e", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_chars long")
    got = sorted((r.doc_id or 0, r.kept, r.base_failed) for r in rules.measure(docs).collect())
    assert got == [
        (0, True, False), (1, True, False), (1, True, False), (2, False, False), (3, False, True),
        (4, False, True), (5, False, True), (6, True, False),
    ]
    clean = rules.clean(docs)
    assert clean.columns == docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[1].text == good and by[1].n_chars == len(good) and by[1].kept == "e"
    assert 3 not in by and 4 not in by and 5 not in by
    assert rules.clean(docs.limit(0)).count() == 0 and rules.measure(docs.limit(0)).count() == 0


def test_failed_lines_go(spark):
    text = prose(20) + "\nHome | News | Sport | About"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in rules.clean(docs).collect()] == [prose(20)]


def test_clean_texts_of_any_layout_are_kept():
    rng = random.Random(6)
    words = [f"word{rng.randrange(3_000)}" + ("." if i % 9 == 8 else "") for i in range(660)]
    plain = " ".join(words)
    with_phrase = plain + " We read the privacy policy before the talk, with all rights reserved."
    wide = " ".join(f"w{rng.randrange(5_000)}" + ("." if i % 12 == 11 else "") for i in range(30_000))
    wrapped = "\n".join(" ".join(words[i : i + 10]) for i in range(0, 660, 10))
    hindi = "\n".join(f"\u092f\u0939 {i} \u0935\u093e\u0915\u094d\u092f \u0939\u0948 \u0914\u0930 {i + 7} \u092d\u0940\u0964" for i in range(60))
    for text in (plain, with_phrase, wide, wrapped, hindi):
        n, *_, failed, kept, lost, cleaned = rules.judge(text)
        assert kept and not failed and not lost and cleaned == text, text[:40]


def test_long_lines_of_few_words_and_short_stock_lines_still_go():
    assert rules.line_fails(b"buy now " * 200, b"buy now ".split() * 200)
    assert rules.line_fails(b"Read our privacy policy.", b"Read our privacy policy.".split())
    menu = b"home page and news\n\nAn ordinary sentence, with an end."
    lines = menu.split(b"\n")
    assert rules.ended_later(lines, [x.split() for x in lines]) == [False, False, False]
    assert rules.ended_later([b"a", b"b.", b"c"], [[b"a"], [b"b."], [b"c"]]) == [True, False, False]
