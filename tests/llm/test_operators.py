"""Every operator against its brute-force version, on rows that are odd in every way."""

import random
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import (
    common,
    lexical_packing,
    license_join,
    line_frequency,
    positional_index,
    prefix_counts,
    quality_ledger,
    simhash_index,
    suffix_ranges,
    token_store,
    url_equivalence,
)
from kindred.sources.scratch import Scratch
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, n_chars long, id string, row string, kept string, lower string, node string, _id string, lead string"
CLASH = ("a", "b", "c", "d", "e", "f", "g")
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (2, "Lone-word"), (3, ""), (4, None), (None, "quick brown fox")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéß ") for _ in range(rng.randint(1, 9))).strip() or "x" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long = prose(1, 20_000)
    near = prose(2, 400).split()
    texts = [
        None, "", "   \n\t ", "x", long, prose(3, 120), prose(3, 120), " ".join(near), " ".join([*near[:200], "changed", *near[201:]]),
        "Menu\nHome\n" + prose(4, 60), "Menu\nHome\n" + prose(5, 60), "Menu\nHome\n" + prose(6, 60) + "\nMenu", ("same words here " * 30).strip(), "A%B### c&d " * 20,
        "before ONE two, three four five six seven eight nine ten eleven twelve thirteen after " + prose(7, 30), "lone word and a quick Brown fox " + prose(8, 100),
        "Under the MIT License; under the mit license\nApache License, Version 2.0\ncc by nc", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation files",
        prose(9, 60) + " " + prose(3, 60), "<|endoftext|> don't I'll've    12'34\n\n\nx" + prose(10, 80), "Kelvin İ under the mit lİcense", long[:5000], "SHOUT NOW!! " * 60,
    ]
    out = [(i, t, f"s{i % 2}", len(t or ""), *CLASH) for i, t in enumerate(texts)]
    out += [out[5], (7, "another text of an id that repeats " + prose(11, 70), None, None, *CLASH), (None, prose(12, 90), "s1", 3, *CLASH), (None, None, None, None, *CLASH)]
    # A group of copies and one of near copies.
    out += [(100 + i, prose(13, 80), "s0", 1, *CLASH) for i in range(15)]
    out += [(200 + i, " ".join([*near[: 10 * i], f"w{i}", *near[10 * i + 1 :]]), "s1", 1, *CLASH) for i in range(20)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(got, *names):
    return sorted((tuple(r[n] for n in names) for r in got), key=repr)


def test_line_frequency(docs, rows, empty):
    done = line_frequency.drop_boilerplate(docs, "source", max_ratio=0.1, min_pages=3).collect()
    want = brute.lines([(r[2], r[1]) for r in rows], 0.1, 3)
    assert any(n for _, _, n in want)
    got = by_row([{"id": r._doc.doc_id, "s": r._doc.source, "t": r.clean_text, "n": r.n_lines, "d": r.n_dropped} for r in done], "id", "s", "t", "n", "d")
    assert got == sorted([(r[0], r[2], *w) for r, w in zip(rows, want)], key=repr)
    kept = line_frequency.stage(docs, max_ratio=0.1, min_pages=3)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert line_frequency.stage(empty).count() == 0


def test_quality_ledger(docs, rows, empty):
    ledger = quality_ledger.ledger(docs)
    got = by_row(quality_ledger.apply_policy(ledger).collect(), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == sorted([(r[0], *brute.quality(r[1])) for r in rows], key=repr)
    kept = quality_ledger.stage(docs)
    assert kept.columns == docs.columns and kept.count() == sum(brute.quality(r[1])[-1] for r in rows)
    assert quality_ledger.stage(empty).count() == 0


def test_quality_ablations(docs):
    bits = [r.failure_bits for r in quality_ledger.ledger(docs).collect()]
    mask = quality_ledger.POLICIES["v2"]
    found = {r.rule: r for r in quality_ledger.ablations(quality_ledger.ledger(docs), "v2").collect()}
    for rule in quality_ledger.RULES:
        if mask >> rule.bit & 1:
            bit, r = 1 << rule.bit, found[rule.name]
            assert (r.n_failed, r.n_failed_alone) == (sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits))
            assert (r.n_kept, r.n_kept_without) == (sum(b & mask == 0 for b in bits), sum(b & mask & ~bit == 0 for b in bits))


@pytest.mark.parametrize("max_key", [64, 2])
def test_simhash(docs, rows, max_key):
    """Also with keys so small that near copies go the way of large groups."""
    got = simhash_index.components(docs, max_key=max_key).collect()
    prints = [(r[0], brute.fingerprint(r[1])) for r in rows]
    want = [(i, f, c) for (i, f), c in zip(prints, brute.components(prints))]
    assert len({c for _, _, c in want}) < len({r[1] for r in rows})
    assert sorted([(r.id, r.fp % (1 << 64), r.component) for r in got], key=repr) == sorted(want, key=repr)


def test_simhash_stage(docs, rows, empty):
    kept = simhash_index.stage(docs)
    assert kept.columns == docs.columns
    prints = [(r[0], brute.fingerprint(r[1])) for r in rows]
    want = {i for (i, _), c in zip(prints, brute.components(prints)) if i is not None and i == c}
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert simhash_index.stage(empty).count() == 0


def test_points_meet_within_four_bits(spark):
    a = 0x0123456789ABCDEF
    near, far = a ^ 0b1111, a ^ 0b11111
    met = simhash_index.points(spark.createDataFrame([(a, 1), (near, 2), (far, 3)], "fp long, node long"))
    assert met.count() == 3 * 2081
    groups = {tuple(sorted(r.n)) for r in met.groupBy("point").agg({"node": "collect_list"}).toDF("point", "n").collect()}
    assert (1, 2) in groups and (2, 3) in groups and not any({1, 3} <= set(g) for g in groups)


PAGES = [
    (1, "https://a.net/x?q=1#f", None), (2, "HTTP://WWW.Example.NET/en/1", "<p>"), (3, "http://u.example.com/de/", ""), (4, "http://v.org/fr/2", "x"), (5, None, "<link rel=canonical href=http://a.net/>"),
    (6, "no scheme", None), (7, "http://plain.org/1", '<LINK rel="canonical" HREF="https://spam.net/2">'), (8, "http://other.org/2", "<meta http-equiv='refresh' content='0; url=http://plain.org/1#top'>"),
    (9, "http://good.org/fr/9", '<link rel="canonical" href="http://mixed.org/1">'), (10, "http://mixed.org/1", '<link rel="canonical" href="//bad.net/1">'), (11, "http://rel.org/a/b", '<link rel="canonical" href="c">'),
    (12, "http://rel.org/a/c", '<link rel="canonical" href="/to?x">'), (13, "https://rel.org/to?x", "<meta http-equiv=refresh content='0;url=http://x.net/9'>"), (14, "http://net", ""), (15, "http://notexample.com/de/", ""), (None, "http://plain.org/1", None), (1, "https://a.net/x?q=1#f", None),
]


def test_url_equivalence(spark):
    pages = spark.createDataFrame([(*p, "n", "h") for p in PAGES], "page_id long, url string, html string, node string, host string")
    done = {(r.page_id, r.host, r.path): (r.rule, r.verdict, r.blocked_by_alias) for r in url_equivalence.verdicts(pages, url_equivalence.rule_table(spark)).collect()}
    assert done == {
        (1, "a.net", "/x"): ("net/", "block", False), (2, "www.example.net", "/en/1"): ("example.net/en/", "allow", False), (3, "u.example.com", "/de/"): ("example.com/de/", "block", False),
        (4, "v.org", "/fr/2"): ("org/fr/", "allow", False), (5, "", ""): (None, "allow", False), (6, "", ""): (None, "allow", False), (7, "plain.org", "/1"): (None, "block", True),
        (8, "other.org", "/2"): (None, "block", True), (9, "good.org", "/fr/9"): ("org/fr/", "allow", False), (10, "mixed.org", "/1"): (None, "allow", False), (11, "rel.org", "/a/b"): (None, "block", True),
        (12, "rel.org", "/a/c"): (None, "block", True), (13, "rel.org", "/to"): (None, "block", True), (14, "net", ""): (None, "allow", False), (15, "notexample.com", "/de/"): (None, "allow", False), (None, "plain.org", "/1"): (None, "block", True),
    }
    assert url_equivalence.verdicts(pages.limit(0), url_equivalence.rule_table(spark)).count() == 0


def test_token_store(spark, docs, rows, empty):
    scratch = Scratch(spark, "test-store")
    token_store.write(docs, WORD, scratch.path("store"), scratch)
    got = token_store.read(spark, scratch.path("store"), sums=True).collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = []
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    assert by_row(got, "doc_id", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    one = token_store.read(spark, scratch.path("store"), [17, 203])
    assert sorted(r.doc_id for r in one.select("doc_id").collect()) == [17, 203]
    token_store.write(empty, WORD, scratch.path("empty"), scratch)
    assert token_store.read(spark, scratch.path("empty")).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_are_cut_as_the_library_sees_white_space(path):
    from kindred.llm import tokens

    rng = random.Random(8)
    texts = [None, "", " ", "\u0085", "a\u00a0 b\u3000\u2003c", "x\u200b y\u1680z", "é\u00e9", "don't\x1cyou", "<|endoftext|> a<|endoftext|>", "w" * 400 + " v"]
    texts += ["".join(rng.choice("ab ,'s\n\tréll<|> e0 .\u00a0\u2028\u205f\u3000\x85é日") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    encoder, tokenizer = tokens.Encoder(path), Tokenizer.from_file(path)
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    encoder.memo.most = 30
    assert [encoder.encode([t])[0] for t in texts] == want and len(encoder.memo.pieces) <= 30
    assert encoder.encode(pa.array(texts).slice(7, 90)) == want[7:97]


def test_half_a_million_pieces_are_asked_for_once():
    """More than the pieces that were remembered when each was a Python string."""
    from kindred.llm import tokens

    encoder, asked = tokens.Encoder(WORD), 0
    ids = encoder.words.ids

    def counted(piece):
        nonlocal asked
        asked += 1
        return ids(piece)

    encoder.words.ids = counted
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join(a + b + c + d for c in letters for d in letters) for a in letters for b in letters[:20]] + ["plus " + "qu" * 20]
    texts += [" ".join(a + b + c + d + "e" for c in letters for d in letters) for a in letters for b in letters[:9]]
    first = encoder.encode(texts)
    once = asked
    assert once > 500_000 and encoder.encode(texts) == first and asked == once


def test_decontamination(spark, docs, rows, empty):
    bench = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, term string")
    names = ("id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted([(r[0], *brute.contamination(r[1], ITEMS)) for r in rows], key=repr)
    assert any(w[-1] for w in want)
    assert by_row(positional_index.contamination(docs, bench).collect(), *names) == want
    # The same with the items taken in several blocks.
    assert by_row(positional_index.contamination(docs, bench, block_words=10).collect(), *names) == want
    kept = positional_index.stage(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert positional_index.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert positional_index.contamination(empty, bench).count() == 0


def test_proximity(spark, docs, rows, empty):
    long = "a b c d e f g h i j k l m n o p q r s t"
    texts = [
        "a b c x y d e f", "a b c " + "z " * 40 + "d e f", None, "", "quick brown fox", "brown fox quick",
        "a b c d e CHANGED g h i j k CHANGED m n o p q r s t", long, "x " * 300 + long.replace("f g", "f and g") + " x" * 300, " ".join(reversed(long.split())), "a b c " * 200,
    ]
    items = [*ITEMS, (6, "a b c d e f"), (7, long), (8, "a b a b a b c")]
    mine = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1, texts[6]), (None, long)], "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = [(i, brute.near_items(t, [x for _, x in items])) for i, t in [*enumerate(texts), (1, texts[6]), (None, long)]]
    assert {n for _, n in want} >= {0, 1, 2}
    for words in (250_000, 3):
        got = positional_index.contamination(mine, tests, block_words=words, near=True).collect()
        assert by_row(got, "id", "n_near_items") == sorted(want, key=repr)
    got = positional_index.contamination(docs, tests, near=True).collect()
    assert by_row(got, "id", "n_near_items") == sorted([(r[0], brute.near_items(r[1], [x for _, x in items])) for r in rows], key=repr)
    assert positional_index.contamination(empty, tests, near=True).count() == 0
    assert positional_index.contamination(mine, tests.limit(0), near=True).filter("n_near_items > 0").count() == 0


def test_prefix_counts(docs, rows, empty):
    tokenizer = Tokenizer.from_file(BYTE)
    tables = prefix_counts.table(docs, BYTE, limit=20)
    got = by_row(tables.collect(), "doc_id", "n_bytes", "n_tokens", "over_limit")
    counts = [len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert got == sorted([(r[0], len((r[1] or "").encode()), n, n > 20) for r, n in zip(rows, counts)], key=repr)
    texts = {r[0]: r[1] for r in rows if r[0] is not None and r[0] != 7}
    for r in tables.filter("doc_id in (3, 14, 16, 19, 20)").collect():
        every = prefix_counts.running(r.prefix_table).tolist()
        text = texts[r.doc_id]
        assert every == [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert r.chars_within_limit == max(i for i, n in enumerate(every) if n <= 20)
    assert all(r.n_tokens <= 5 for r in prefix_counts.within_budget(tables, 5).collect())
    assert prefix_counts.table(empty, BYTE).count() == 0


def test_prefix_counts_of_odd_strings():
    counter = prefix_counts.counter(BYTE)
    rng = random.Random(5)
    texts = ["a  b", "I'll've don't'r\n\n x'rest 'l", "x <|endoftext|> y<|endoftext", "\t \n a\x1cb \x85z", "<|endoftext|><|endoftext|>b'v"]
    texts += ["".join(rng.choice("ab 's\n\tréll<|>e0 9'vdm!,") for _ in range(50)) for _ in range(60)]
    for t in texts:
        got = np.cumsum(np.frombuffer(counter.changes(t), np.int8), dtype=int).tolist()
        assert got == [len(counter.tokenizer.encode(t[: i + 1], add_special_tokens=False).ids) for i in range(len(t))], t


def test_prefix_counts_of_many_added_tokens():
    counter = prefix_counts.counter(BYTE)
    text = "<|endoftext|>" * 5000 + "ab"
    got = np.cumsum(np.frombuffer(counter.changes(text), np.int8), dtype=int)
    assert got[-1] == len(counter.tokenizer.encode(text, add_special_tokens=False).ids) == 5001
    assert got[12::13].tolist() == list(range(1, 5001))


@pytest.mark.parametrize("shard_tokens", [1_000_000, 5_000])
def test_packing(docs, rows, empty, shard_tokens):
    tokenizer = Tokenizer.from_file(BYTE)
    pieces = lexical_packing.pack(docs, BYTE, shard_tokens=shard_tokens).collect()
    ids = [(r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")) for r in rows]
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in ids)
    single = {i: x for i, x in ids if i is not None and [r[0] for r in rows].count(i) == 1}
    for doc, own in single.items():
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(own[at : at + p.length].tobytes())
            at += p.length
        assert at == len(own)
    sequences = {}
    for p in sorted(pieces, key=lambda p: p.offset):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values()) <= 2048
    # Only the last sequence of a shard is not full.
    total = sum(len(x) for _, x in ids)
    assert sum(n < 2048 for n in sequences.values()) <= max(1, -(-total // shard_tokens))
    assert lexical_packing.pack(empty, BYTE).count() == 0


@pytest.mark.parametrize("range_rows", [500_000, 300])
def test_suffix_ranges(docs, rows, empty, monkeypatch, range_rows):
    """Also with ranges so small that groups of equal suffixes lie across many."""
    monkeypatch.setattr(suffix_ranges, "RANGE_ROWS", range_rows)
    hashed = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", common.row_key(docs["text"]).alias("h")).collect()}
    order = sorted({(r[0] is not None, r[0] or 0, hashed[r[0], r[1]], r[1]) for r in rows}, key=lambda k: k[:3])
    want = brute.passages([((k[0], k[1], k[3]), k[3]) for k in order])
    expected = sorted([(r[0], *want[r[0] is not None, r[0] or 0, r[1]]) for r in rows], key=repr)
    got = by_row(suffix_ranges.dedup(docs).collect(), "id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sum(w[2] for w in expected) > 0 and got == expected
    assert suffix_ranges.dedup(empty).count() == 0


def test_license_join(docs, rows, empty):
    done = license_join.scan(docs).collect()
    got = by_row(done, "id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    want = [(r[0], *brute.licences(r[1], license_join.PHRASES, license_join.TEMPLATES)) for r in rows]
    assert got == sorted(want, key=repr)
    assert any(w[6] and not w[5] for w in want)
    assert license_join.scan(docs, templates=[]).filter("labels <> base_labels").count() == 0
    assert license_join.scan(empty).count() == 0


def test_wrapped_notices(spark):
    """A notice wrapped at 70 columns, as a comment or not, is found like the same text on one line."""
    wanted = {label: max((t for x, t in license_join.TEMPLATES if x == label), key=len) for label in ("mit", "gpl", "bsd", "mpl-2")}
    rows = []
    for lead, label in [("", "mit"), (" * ", "gpl"), ("# ", "bsd"), ("// ", "mpl-2"), ("", "gpl")]:
        lines = textwrap.wrap(wanted[label], 70 - len(lead))
        assert len(lines) > 1
        rows.append((label, prose(len(rows), 400) + "\n" + "\n".join(lead + x for x in lines) + "\n" + prose(99, 33 * len(rows))))
    # Words of a template far from each other are no notice.
    rows.append(("", (" " + "filler " * 60).join(wanted["bsd"].split())))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.id: (r.labels, r.score) for r in license_join.scan(docs).collect()}
    assert got == {i: (label, 1.0 if label else 0.0) for i, (label, _) in enumerate(rows)}


def test_neighbours_are_those_of_whole_queries():
    """Every text of a shard by BM25 over all ids of the seed, against a plain loop."""
    rng = np.random.default_rng(3)
    rests = [rng.zipf(1.3, int(n)).clip(1, 199).astype(np.uint16) for n in rng.integers(1, 300, 150)]
    rests += [rests[0], rests[0]]
    found = np.zeros(200, dtype=np.int64)
    for r in rests:
        found[np.unique(r)] += 1
    idf, mean = lexical_packing.inverse_frequency(found, len(rests)), float(np.mean([len(r) for r in rests]))
    shard = lexical_packing.Shard(rests, idf, mean)
    unused = rng.random(len(rests)) < 0.9
    for seed in range(0, len(rests), 7):
        scores = {}
        for i, r in enumerate(rests):
            counts = Counter(r.tolist())
            norm = lexical_packing.K1 * (1 - lexical_packing.B + lexical_packing.B * len(r) / mean)
            score = sum(float(idf[t]) * n * (lexical_packing.K1 + 1) / (n + norm) for t, n in counts.items() if t in set(rests[seed].tolist()))
            if unused[i] and score > 0:
                scores[i] = score
        got = list(shard.neighbours(seed, unused))
        assert sorted(got) == sorted(scores)
        assert all(scores[a] >= scores[b] - 1e-3 for a, b in zip(got, got[1:]))


def test_common_terms_are_scored_as_rows():
    """Of a term that many texts have, no list of postings is walked for a seed; scores and their order stay."""
    rng = np.random.default_rng(4)
    rests = [np.concatenate([rng.permutation(60), 60 + rng.integers(0, 5000, 20)]).astype(np.uint16) for _ in range(200)]
    rests += [rests[3], rests[3], np.array([5100], dtype=np.uint16)]
    found = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=5200)
    idf = lexical_packing.inverse_frequency(found, len(rests))
    shard = lexical_packing.Shard(rests, idf, 80.0)
    assert (shard.row[:60] >= 0).all() and shard.rows.size <= lexical_packing.COMMON * len(shard.text)
    for seed in (0, 3, 202):
        want = np.zeros(len(rests))
        for t in np.unique(rests[seed]).tolist():
            span = slice(shard.heads[t], shard.heads[t + 1])
            want[shard.text[span]] += shard.weight[span]
        assert np.allclose(shard.scores(seed), want, rtol=1e-5)
    same = shard.scores(3)
    assert same[3] == same[200] == same[201] and [i for i in shard.neighbours(3, np.ones(len(rests), bool)) if i in (3, 200, 201)] == [3, 200, 201]


def test_shards_hold_equally_many_tokens(spark):
    """Ranges of equally many rows put all long rests into one shard; so did rests without an id and of one text."""
    row = lambda i, doc, n, near: (doc, 0, n, 7, n, 0, i, near, b"")
    rows = [row(i, i, 1, 1) for i in range(4000)] + [row(i, i, 100, 2) for i in range(4000, 4400)] + [row(i, None, 10, 3) for i in range(4400, 8400)]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, seq long, near long, rest binary"
    found = lexical_packing.dealt(spark.createDataFrame(rows, schema), 8400)
    parts = found.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("length").alias("n"), F.count("*").alias("rows")).collect()
    assert sum(r["n"] for r in parts) == 84_000 and sum(r["rows"] for r in parts) == 8400
    assert found.rdd.getNumPartitions() == 10 and max(r["n"] for r in parts) < 1.5 * 8400


def test_a_worker_packs_without_the_pieces_it_has_encoded(spark, monkeypatch):
    from kindred.llm import tokens

    monkeypatch.setattr(tokens, "_ENCODERS", {})
    before = tokens.encoder(BYTE).encode(["some words, again some words"])
    monkeypatch.setattr(lexical_packing, "map_batches", lambda df, run, schema: run(iter(())))
    assert list(lexical_packing.pack_rests(Rests(), np.dtype("<u2"), np.zeros(0), 1.0)) == [] and not tokens._ENCODERS
    assert tokens.encoder(BYTE).encode(["some words, again some words"]) == before


class Rests:
    """Stands for a table of rests."""

    def select(self, *columns):
        return self
