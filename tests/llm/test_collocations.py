"""Collocations against a plain count of all phrases, and the tiles against a dictionary."""

import re
from collections import Counter

import numpy as np
import pytest

from mendtable.llm import collocations


def plain(rows, least=30, longest=4, covered=80, top=2000):
    """For rows (text, lang): the query's rows, by counting every phrase."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in counts.items() if n >= least}
    candidates = {key: n for key, n in frequent.items() if len(key[1]) > 1}
    out = {}
    for (lang, words), a in candidates.items():
        cuts = [(2000000 * a // (frequent[lang, words[:k]] + frequent[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            x == lang and len(longer) > len(words) and 100 * n >= covered * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (x, longer), n in candidates.items()
        )
        if not inside:
            row = (" ".join(words), a, frequent[lang, words[:k]], frequent[lang, words[k:]], totals[lang], score)
            out.setdefault(lang, []).append(row)
    ranked = []
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        ranked += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return ranked


def compare(df, want):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(want)


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string")
    for name in ("phrase", "size", "n", "words", "lang_", "part", "rank", "a"):
        df = df.selectExpr("*", f"7 AS `{name}`")
    return df


ODD = (
    [(None, "en"), ("", "en"), (" \t", None), ("...\n\r\x0b\x0c", "en"), ("one", "xx")]
    + [("New York City, new york city! new York", "en")] * 15 + [("new york is new york city hall", None)] * 16
    + [("a a a a a a a a", "en")] * 4 + [("é x y z É Ü;x\x00\x01 b", "fr")] * 31
    + [("to be or not to be that is the question " * 700, "en"), ("tie one\ttie two  tie one", "de")]
    + [("tie one\ttie two  tie one", "de")] * 14 + [("b c. b d. c b", "de")] * 30
)


@pytest.mark.parametrize("rows", [ODD, [], [(None, None)]])
def test_odd_texts(spark, rows):
    compare(collocations.collocations(table_of(spark, rows)), plain(rows))


@pytest.mark.parametrize("least, longest, covered, top", [(3, 4, 80, 2000), (5, 3, 50, 7), (2, 2, 100, 40), (4, 6, 70, 100), (3, 1, 80, 5)])
def test_test_table(spark, plain_docs, least, longest, covered, top):
    rows = [(t, ("en", "de", None)[i % 3]) for i, t in plain_docs[:60]]
    found = collocations.collocations(table_of(spark, rows), least=least, longest=longest, covered=covered, top=top)
    compare(found, plain(rows, least, longest, covered, top))


@pytest.mark.parametrize("side, dense", [(2, 1), (4, 3), (16, 1 << 30)])
def test_tiles(side, dense, monkeypatch):
    monkeypatch.setattr(collocations, "SIDE", side)
    monkeypatch.setattr(collocations, "DENSE", dense)
    dice = np.random.default_rng(side)
    for size in (0, 1, 500):
        left, right = dice.geometric(0.2, size) % 23, dice.geometric(0.3, size) % 23
        rows, columns, times, number = collocations.tiled_pairs(left, right, 23)
        want = Counter(zip(left.tolist(), right.tolist()))
        assert dict(zip(zip(rows.tolist(), columns.tolist()), times.tolist())) == want and len(rows) == len(want)
        assert (rows[number] == left).all() and (columns[number] == right).all()


def test_a_group_with_a_full_filter(plain_docs):
    texts = [t or "" for _, t in plain_docs[:40]]
    group = collocations.Group("en", [t.encode() for t in texts])
    # a filter that lets everything through changes no count
    level = group.level
    for k in range(3):
        passed = group.passing(level, b"\xff" * 1024)
        assert passed.all()
        level = level.ranked(passed)
        if k == 1:
            runs = group.runs(level).column("phrase").to_pylist()
        level = level.longer(group.follows if k == 0 else None)
    counted = {tuple(r) for r in zip(group.counts(level).column("phrase").to_pylist(), level.times.tolist())}
    want, pieces = Counter(), []
    for t in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update(" ".join(words[i : i + 4]) for i in range(len(words) - 3))
            pieces += [" ".join(words)] * (len(words) > 3)
    assert counted == set(want.items()) and runs == pieces
