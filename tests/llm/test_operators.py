"""Every operator against a brute-force version, on odd rows and on the smallest test table."""

import json
import os
import re
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

os.environ["TOKENIZERS_PARALLELISM"] = "false"

from mendtable.llm import bpe, dac, decontaminate, exact_dedup, fm_index, hashing, pii, simhash, stretches, suffix_array  # noqa: E402


def same_rows(df, columns, want):
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted(map(tuple, want), key=repr)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_file())


@pytest.fixture(params=["odd", "plain", "empty"])
def rows(request, odd_texts, plain_docs):
    return {"odd": odd_texts, "plain": plain_docs, "empty": []}[request.param]


def test_exact_dedup(docs_of, rows):
    found = exact_dedup.exact_duplicates(docs_of(rows))
    same_rows(found, ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], brute.exact_copies(rows))


def test_exact_dedup_keeps_rows(docs_of, rows):
    docs = docs_of(rows)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = [(r[0], r[4]) for r in brute.exact_copies(rows) if r[3]]
    got = [(r.doc_id, brute.sha(re.sub(brute.SPACE, " ", r.text or ""))) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("split", [1, 1024])
def test_repeated_bytes(docs_of, rows, split, monkeypatch):
    monkeypatch.setattr(stretches, "SPLIT", split)
    monkeypatch.setattr(stretches, "SHARD_BYTES", 20_000 if split == 1 else 1_500_000)
    found = suffix_array.remove_repeated_bytes(docs_of(rows))
    same_rows(found, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.repeated_bytes(rows))


@pytest.mark.parametrize("split", [1, 1024])
def test_repeated_words(docs_of, rows, split, monkeypatch):
    monkeypatch.setattr(stretches, "SPLIT", split)
    monkeypatch.setattr(stretches, "SHARD_BYTES", 20_000 if split == 1 else 1_500_000)
    found = fm_index.remove_repeated_words(docs_of(rows))
    same_rows(found, ["doc_id", "n_words", "n_removed", "kept_sha256"], brute.repeated_words(rows))


def test_long_text_in_chunks(docs_of, odd_texts, monkeypatch):
    monkeypatch.setattr(stretches, "CHUNK", 1 << 12)
    # workers see the module as it is on disk, so the chunks are tested here
    data = [(t or "").encode() for _, t in odd_texts]
    ends = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    seen = set()
    for group, offset, units, borders, piece in stretches.Bytes(200, 64).chunks(raw, ends):
        first, n, _ = stretches.find_stretches(units, borders, 200, 64)
        for p, k in zip(first.tolist(), n.tolist()):
            text = int(np.searchsorted(borders, p, "right")) - 1
            start = p - int(borders[text]) + offset
            assert piece(p, k) == data[group + text][start : start + k + 199]
            seen |= {(group + text, start + j) for j in range(k)}
    assert seen == {(i, p) for i, d in enumerate(data) for p in range(len(d) - 199)}


def test_solvers_agree_with_counting():
    shuffled = np.random.default_rng(5)
    for case in range(60):
        window = int(shuffled.choice([3, 5, 8]))
        counts = shuffled.integers(1, 9, shuffled.integers(1, 10)).tolist()
        pieces = ["".join(shuffled.choice(list("ab" if case % 2 else "abcdef"), n + window - 1)) for n in counts]
        windows = [p[i : i + window] for p, n in zip(pieces, counts) for i in range(n)]
        want = [windows.count(w) > 1 for w in windows]
        by_suffix = suffix_array.repeated_by_suffixes(window)([p.encode() for p in pieces], counts)
        by_index = fm_index.repeated_by_index(window)([" ".join(p).encode() for p in pieces], counts)
        for flags, heads in (by_suffix, by_index):
            assert flags.tolist() == want
            assert sorted(windows[i] for i in heads) == sorted({w for w, f in zip(windows, want) if f})


def test_simhash(docs_of, rows):
    found = simhash.near_duplicates(docs_of(rows))
    same_rows(found, ["doc_id", "fingerprint", "component_id"], brute.near_copies(rows))


def test_simhash_keeps_one(docs_of):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, "other words here now"), (5, None), (4, ""), (6, "a  b c d")]
    docs = docs_of(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


@pytest.mark.parametrize("bucket", [2, 2048])
def test_links_of_close_fingerprints(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    shuffled = np.random.default_rng(2)
    prints = set()
    for center in shuffled.integers(0, 1 << 63, 6).tolist():
        for _ in range(60):
            center_near = center
            for b in shuffled.choice(64, shuffled.integers(0, 5), replace=False).tolist():
                center_near ^= 1 << b
            prints.add(center_near)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in prints}
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed.values()], "fp bigint"), 2)
    from mendtable.llm.components import connected

    root = {r.u: r.root for r in connected(edges).collect()}
    want = brute.components(prints)
    got = {}
    for f in prints:
        got.setdefault(root.get(signed[f], signed[f]), set()).add(f)
    groups = {}
    for f, r in want.items():
        groups.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_components_of_a_path(spark):
    from mendtable.llm.components import connected

    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "u bigint, v bigint")
    assert {r.u: r.root for r in connected(edges).collect()} == {i: 0 for i in range(1, 201)} | {500: 400}


@pytest.fixture
def items(spark, odd_texts):
    passage = odd_texts[5][1]
    rows = [
        (10, passage[100:600]), (9, passage[100:600]), (3, "short item"), (4, "one"), (5, None), (6, "..."),
        (7, "word7 of the PASSAGE word8"), (None, passage[:300]), (8, "long1 text1 " * 20),
    ]
    return rows, spark.createDataFrame(rows, "item_id bigint, text string")


def test_decontamination(docs_of, rows, items):
    found = decontaminate.overlap_digests(docs_of(rows), items[1])
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same_rows(found, columns, brute.overlaps(rows, items[0]))


def test_shared_preambles_make_no_pairs(spark, monkeypatch):
    preamble = " ".join(f"pre{i}" for i in range(30))
    rows = [(i, f"own{i} {preamble} more{i} words{i % 7}") for i in range(200)]
    given = [(i, f"{preamble} item{i % 150} says{i}") for i in range(200)]
    written = {}
    keep = decontaminate.stored

    def counted(df, name):
        out = keep(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "stored", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = decontaminate.overlap_digests(docs, spark.createDataFrame(given, "item_id bigint, text string"))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same_rows(found, columns, brute.overlaps(rows, given))
    assert max(written.values()) <= 3 * (len(rows) + len(given))
    whole = decontaminate.overlaps(docs, spark.createDataFrame(given, "item_id bigint, text string")).collect()
    assert all(r.items == sorted(map(str, range(200))) and r.n_items == 200 for r in whole)


def test_decontamination_without_items(docs_of, odd_texts, items):
    docs = docs_of(odd_texts)
    kept = decontaminate.drop_contaminated(docs, items[1].limit(0))
    assert kept.columns == docs.columns and kept.count() == len(odd_texts)


def test_personal_data(docs_of, rows):
    extra = [
        (20, "mail a.b+c@x-y.example.com.x@z.org, 1.2.3.4.5.6.7.8 and 300.1.1.1"),
        (21, "4111 1111 1111 1111 or 4111-1111-1111-1112, +1 (555) 123-4567, +1 2 3, call (555) 123-4567"),
        (22, "é🙂 a@b a@b.c @ a@@b.c 1" + "1" * 3000 + " " + "1 " * 4000 + "+" + "1-" * 4000), (23, "x@y.z_q@r.s"),
    ]
    given = rows + extra if rows else rows
    found = pii.personal_data(docs_of(given))
    same_rows(found, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], brute.personal(given))
    for r in found.collect():
        spans = {tuple(s.split(":")) for s in r.spans.split(",") if s}
        text = dict(given).get(r.doc_id) or ""
        if sum(i == r.doc_id for i, _ in given) == 1:
            base = {(("email", "ip", "card", "phone")[k], str(a), str(b)) for a, k, b in brute.base_spans(text)}
            assert base <= spans and len(spans - base) == r.n_added


def test_reliabilities_tell_good_labelers_from_bad():
    # the first four labelers agree, the last one votes at random
    counts = [((1, 1, 1, 1, 0), 50), ((1, 1, 1, 1, 1), 50), ((0, 0, 0, 0, 1), 50), ((0, 0, 0, 0, 0), 50)]
    found = pii.reliabilities(counts)
    assert found[1, 1, 1, 1, 0] > 0.95 and found[0, 0, 0, 0, 1] < 0.05


def test_bpe_round_trip(docs_of, rows, tokenizer):
    def want():
        for i, t in rows:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids
            yield i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(tokenizer.decode(ids, skip_special_tokens=False))

    same_rows(bpe.round_trip(docs_of(rows)), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], want())


def test_bpe_encode_then_decode(docs_of, odd_texts):
    rows = [r for r in odd_texts if r[0] is not None and r[0] != 7]
    back = bpe.decode(bpe.encode(docs_of(rows)))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in rows}


def test_bpe_of_random_strings(tokenizer):
    codec = bpe.Codec(open(bpe.vocabulary_file()).read())
    shuffled = np.random.default_rng(1)
    letters = list("aab  \n\tstreé漢🙂\x85\x1c–.,123½<|>'") + ["<|endoftext|>", "  ", "'s", "'ll", "ing", " the"]
    texts = ["".join(shuffled.choice(letters, shuffled.integers(0, 50))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 900, " " * 700, "the" * 500, "1234567890" * 100, "=-" * 400]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert codec.encode(texts) == want
    assert [codec.decoded_text(i) for i in want] == [tokenizer.decode(i, skip_special_tokens=False) for i in want]


def alike(size):
    """Two texts of equal length whose polynomial hashes modulo 2**64 agree under every odd base from 1,024 letters on."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [512, 1024, 2048])
@pytest.mark.parametrize("tasks", [1, 2])
def test_texts_of_equal_hash(spark, tokenizer, size, tasks):
    one, two = alike(size)
    assert size < 1024 or len(set(hashing.span_hashes(np.frombuffer((one + two).encode(), np.uint8), np.array([0, size]), np.array([size, 2 * size])))) == 1
    for texts in ([one, two], [two, one], [f"{one} x {two}", two, f"{two} {one}", one]):
        rows = [(i, t) for i, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(tasks, "doc_id")
        want = [(i, tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows]
        assert {r.doc_id: r.ids for r in bpe.encode(docs).collect()} == dict(want)
        same_rows(dac.written_and_read(docs), ["doc_id", "start", "n_tokens", "ids_crc32"], brute.token_ids(rows, lambda t: dict(zip(texts, (w for _, w in want)))[t]))


def test_spans_of_equal_hash_are_told_apart():
    one, two = (t.encode() for t in alike(1024))
    parts = [one, b"x", two, one, two, b"x", b"yy", b"a" * 70_000, b"a" * 70_001]
    stops = np.cumsum([len(p) for p in parts])
    starts = stops - [len(p) for p in parts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    seen, first, number = hashing.distinct_spans(raw, starts, stops)
    assert [parts[i] for i in first[number]] == parts and len(first) == len(set(parts)) == len(seen) + 1
    flags = hashing.equal_spans(raw, starts[[0, 0, 2, 1]], raw, starts[[3, 2, 4, 5]], np.array([1024, 1024, 1024, 1]))
    assert flags.tolist() == [True, False, True, True]


@pytest.mark.parametrize("remembered", [1, 50, 100_000])
def test_segment_table_forgets(tokenizer, remembered, plain_docs):
    codec = bpe.Codec(open(bpe.vocabulary_file()).read())
    codec.table.remembered = remembered
    one, two = alike(1024)
    for _ in range(2):
        for texts in ([t for _, t in plain_docs[:50]], [one], [two, "x"], [one, two], [t for _, t in plain_docs[30:80]]):
            assert codec.encode(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_bpe_refuses_other_vocabularies():
    data = json.loads(open(bpe.vocabulary_file("word_bpe_49k.json")).read())
    with pytest.raises(ValueError):
        bpe.Codec(json.dumps(data))


def test_token_files(docs_of, rows, tokenizer, monkeypatch):
    monkeypatch.setattr(dac, "PART_BYTES", 20_000)
    want = brute.token_ids(rows, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    found = [tuple(r) for r in dac.written_and_read(docs_of(rows)).orderBy("start").collect()]
    # rows that share an id may stand in any order; all others stand where they must
    ids = [r[0] for r in want]
    assert [r[0] for r in found] == ids
    assert sorted((r[0], *r[2:]) for r in found if r[0] is not None) == sorted((r[0], *r[2:]) for r in want if r[0] is not None)
    assert [r for r in found if ids.count(r[0]) == 1] == [r for r in want if ids.count(r[0]) == 1]


def test_many_parts(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "string(id) AS text")
    begun = time.monotonic()
    dealt = dac.in_parts(docs, 10_000)
    dealt._jdf.queryExecution().executedPlan()
    assert time.monotonic() - begun < 10 and "10000" in dealt._jdf.queryExecution().optimizedPlan().toString()
    few = dac.in_parts(docs.repartition(7), 300).selectExpr("spark_partition_id() AS part", "doc_id")
    bounds = few.groupBy("part").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("part").collect()
    assert len(bounds) > 250 and all(a.high < b.low for a, b in zip(bounds, bounds[1:]))
    shards = spark.range(30_000).selectExpr("int(id * 7 % 30000) AS part", "id AS n_tokens")
    sizes = {r.part: r.n_tokens for r in shards.collect()}
    total, want = 0, {}
    for part in sorted(sizes):
        want[part], total = total, total + sizes[part]
    assert {r.p: r.offset for r in dac.part_offsets(shards).collect()} == want


def test_tokens_between(spark, docs_of, plain_docs, tokenizer, tmp_path):
    dac.write_tokens(docs_of(plain_docs), str(tmp_path / "t"))
    flat = [x for _, t in plain_docs for x in [*tokenizer.encode(t, add_special_tokens=False).ids, 0]]
    got = dac.tokens_between(spark, str(tmp_path / "t"), 1000, 1600).orderBy("number").collect()
    assert [(r.number, r.id) for r in got] == list(zip(range(1000, 1600), flat[1000:1600]))


@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 1 << 31])
def test_shard_random_access(top):
    shuffled = np.random.default_rng(top)
    ids = np.minimum(shuffled.integers(0, top, 5000), shuffled.integers(0, top, 5000))
    shard = dac.Shard(dac.encode_ids(ids))
    at = shuffled.integers(0, 5000, 700)
    assert shard.ids(at).tolist() == ids[at].tolist()
    for a, b in ((0, 5000), (63, 64), (511, 1025), (4999, 5000), (7, 7)):
        assert shard.run(a, b).tolist() == ids[a:b].tolist()
    assert dac.Shard(dac.encode_ids(ids[:0])).run(0, 0).tolist() == []


def test_learned_spans_of_planted_texts(docs_of):
    """Addresses and numbers that no base pattern takes are added, numbers of other sorts are not; the learned part
    alone can find them, so the test fails without it."""
    rows, want = [], {}

    def add(before, span, after, kind=None):
        if kind:
            want[len(rows)] = f"{kind}:{len(before)}:{len(before) + len(span)}"
        rows.append((len(rows), before + span + after))

    for i in range(40):
        add("some words, please contact ", f"ana.k{i}@site{i}.org", " for more")
        add("or call ", f"+1 (212) 555-{1000 + i}", " at noon")
        add("the host ", f"10.{i}.3.{i + 1}", " is down")
        add("it ran as version ", f"{300 + i}.1.2.{i}", " since then")
    base = len(rows)
    for i in range(15):
        add("please write to ", f"joe{i} [at] mail{i} [dot] com", " for more", "email")
        add("call me, phone ", f"(212) 555-{2000 + i}", " at noon", "phone")
        add("the server addr ", f"2001:db8:0:1:2:3:4:{i:x}", " is down", "ip")
        add("the book, isbn ", f"212 555 {3000 + i}", " is old")
        add("lines 9,", f"212 555 {4000 + i}", ",77 were summed")
    found = pii.personal_data(docs_of(rows)).collect()
    added = {r.doc_id: r.spans for r in found if r.n_added}
    assert added == want and min(added) >= base
