"""License templates against a backtracking matcher over words."""

import re

import pytest

from reelhouse.llm import licenses
from reelhouse.llm.license_templates import PHRASES, TEMPLATES
from tests.llm.conftest import by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_list(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(template):
    """A template as a regular expression over words joined by one space."""
    out = []
    for part in re.split(r"(</?optional>|</?one>|<any [^>]*/>|\|)", template):
        if part == "<optional>" or part == "<one>":
            out.append("(?:")
        elif part == "</optional>":
            out.append(")?")
        elif part == "</one>":
            out.append(")")
        elif part == "|":
            out.append("|")
        elif part.startswith("<any"):
            a, b = re.search(r"(\d+)-(\d+)", part).groups()
            out.append(rf"(?:\S+ ){{{a},{b}}}")
        else:
            out += [re.escape(w) + " " for w in word_list(part)]
    return re.compile("".join(out))


PATTERNS = [(label, pattern(text)) for label, text in TEMPLATES]


def filled(template):
    """A text that the template accepts, all optional regions present."""
    text = re.sub(r"</?optional>", " ", template)
    text = re.sub(r'<any words="(\d+)-\d+"/>', lambda m: "Some " * int(m[1]), text)
    while "<one>" in text:
        text = re.sub(r"<one>([^<]*)</one>", lambda m: m[1].split("|")[0], text)
    return text


def brute(text):
    w = word_list(text)
    base = [(i, label) for i in range(len(w)) for phrase, label in PHRASES if w[i:i + len(phrase.split())] == phrase.split()]
    joined, at = " ".join(w) + " " if w else "", [0]
    for x in w:
        at.append(at[-1] + len(x) + 1)
    labels = {label for label, p in PATTERNS for i in at[:-1] if p.match(joined, i)}
    named = {label for _, label in base}
    starts = [i for i, _ in base]
    return (len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(named)), ",".join(sorted(named | labels)))


def texts():
    out = [None, "", " . ", "GNU General Public License", "cc-by CC BY, mit  license; Apache\nLicense", "mit licenses", "MIT", "cc by" * 3]
    for label, t in TEMPLATES:
        full = filled(t)
        out += [full, full.upper().replace(" ", "\n"), "word " + full + " cc by " + full, re.sub("<optional>[^<]*</optional>", "", filled(re.sub("<optional>[^<]*</optional>", "", t)))]
        words = full.split()
        for k in (0, len(words) // 3, len(words) - 1):
            out.append(" ".join(words[:k] + words[k + 1:]))
            out.append(" ".join(words[:k] + ["odd"] + words[k:]))
    out += ["Released under the MIT License.", "licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
            "Licensed under the Apache License, Version 2.0.", "licensed under the apache license version 3", "under " * 50_000 + "the mit license"]
    return out


def test_scan_equals_backtracking(spark):
    rows = list(enumerate(texts())) + [(None, "mit license"), (3, "mit license")]
    got = licenses.license_labels(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    shown = by_id(got.drop("score"))
    assert shown == sorted(((i, *brute(t)) for i, t in rows), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got.collect())


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_each_template_accepts_itself_and_no_missing_mandatory_word(number):
    label, t = TEMPLATES[number]
    scan = licenses.Scanner([TEMPLATES[number]], [])
    words = licenses.word_list(filled(t))
    assert scan.automaton.ends_from(words) == {0: len(words)}
    bare = licenses.word_list(filled(re.sub("<optional>(?:(?!</?optional>).)*</optional>", "", re.sub(
        "<optional>(?:(?!</?optional>).)*</optional>", "", t, flags=re.S), flags=re.S)))
    assert scan.automaton.ends_from(bare) == {0: len(bare)}
    if "<any" not in t:
        for k in range(len(bare)):
            assert scan.automaton.ends_from(bare[:k] + ["odd"] + bare[k + 1:]).get(0, 0) <= k


def test_regions():
    scan = licenses.Automaton([("x", 'a <optional>b <optional>c</optional></optional> <any words="1-2"/> <one>d e | f</one>')])
    for text, n in (("a q d e", 4), ("a b c q q f", 6), ("a b q f", 4), ("a f", None), ("a q q q q f", None), ("a c q f", 4), ("a q d", None)):
        assert scan.ends_from([w.encode() for w in text.split()]).get(0) == n, text
    with pytest.raises(ValueError):
        licenses.Automaton([("x", "a <optional>b")])
    with pytest.raises(ValueError):
        licenses.Automaton([("x", '<any words="0-2"/> a')]).openings()


def test_edges(edge_docs, edge_rows, no_docs):
    got = licenses.license_labels(edge_docs)
    assert by_id(got.select("doc_id", "n_words")) == sorted(((i, len(word_list(t))) for i, t in edge_rows), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert licenses.license_labels(no_docs).count() == 0
