"""Brute-force versions of the operators on texts, over rows with every oddity."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
import xxhash
import zstandard
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrasieve.llm import bpe, iblt, lines, quality, shards, simhash, suffixes, wordpiece


def key(rows):
    return Counter(tuple(r) for r in rows)


# ---- SimHash


def brute_simhash(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = sorted(set(prints))
    root = {p: p for p in ids}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (a ^ b).bit_count() <= 2:
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {p: top(p) for p in ids}


def test_simhash_and_components(spark, docs, odd_docs, no_docs):
    prints = [(r[0], brute_simhash(r[1])) for r in odd_docs]
    root = brute_components([p for _, p in prints])
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    got = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert key(got) == Counter((d, f"{p:016x}", least.get(root[p])) for d, p in prints)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_close_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 20)]
    prints = {b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (12, 2))} | {0, 1, 2**63, 2**64 - 1}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    links = simhash.ball_links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"))
    roots = simhash.connected_components(links)
    got = {r.node & (2**64 - 1): r.root for r in roots.collect()}
    want = brute_components(prints)
    classes = lambda of: {frozenset(p for p in prints if of(p) == r) for r in {of(p) for p in prints}}
    assert classes(lambda p: got.get(p, signed(p))) == classes(lambda p: want[p])


def test_keep_one(spark, docs, odd_docs, no_docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    prints = {(r[0], r[1]): brute_simhash(r[1]) for r in odd_docs}
    root = brute_components(prints.values())
    best = {}
    for (doc, _), p in prints.items():
        rank = (doc is None, doc or 0)
        best[root[p]] = min(rank, best.get(root[p], rank))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for none, d in best.values() if not none)
    assert simhash.keep_one(no_docs).count() == 0
    lone = docs.filter("doc_id IS NULL")
    assert simhash.keep_one(lone).count() == 3


# ---- byte-level BPE


@pytest.fixture(scope="module")
def library():
    path, pattern = bpe.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe.default_vocabulary()
    return bpe.Codec(open(path, "rb").read(), pattern)


def test_bpe(docs, odd_docs, no_docs, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for doc, text, *_ in odd_docs:
        ids = library.encode_ordinary(text or "")
        want[(doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))] += 1
    assert key(bpe.round_trip(docs).collect()) == want
    assert bpe.round_trip(no_docs).count() == 0
    both = bpe.decode(bpe.encode(docs.select("doc_id", "text"))).select("text", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both)
    checked = bpe.encode_checked(docs)
    assert checked.filter("NOT exact OR n_tokens <> size(ids)").count() == 0 and set(docs.columns) < set(checked.columns)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x1c\x85\xa0 　'sStTaé日1½²!_-"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_bpe_as_the_library(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_perfect_hash():
    keys = [str(i).encode() for i in range(5000)]
    found = bpe.PerfectHash(keys)
    assert sorted(found.slot(k) for k in keys) == list(range(5000)) and found.slot(b"none") == -1 and bpe.PerfectHash([]).slot(b"x") == -1


# ---- word-piece counts


def test_token_counts(docs, odd_docs, no_docs):
    pieces = set(bpe.read_ranks(open(bpe.default_vocabulary()[0], "rb").read()).values())
    longest = max(map(len, pieces))

    def greedy(word):
        at = n = 0
        while at < len(word):
            at += next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), len(word))
            n += 1
        return n

    want = Counter((d, len((t or "").encode()), len((t or "").split()), sum(greedy(b" " + w.encode()) for w in (t or "").split())) for d, t, *_ in odd_docs)
    assert key(wordpiece.token_counts(docs).collect()) == want
    assert wordpiece.token_counts(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=1, max_size=5), min_size=1, max_size=12), st.text(alphabet="abcd", max_size=20))
def test_matcher(vocabulary, word):
    at = n = 0
    while at < len(word):
        k = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in vocabulary), 0)
        if not k:
            n = 1
            break
        at, n = at + k, n + 1
    assert wordpiece.Matcher([p.encode() for p in vocabulary]).count(word.encode()) == n


# ---- sharding


def test_sharding(docs, odd_docs, no_docs):
    rows = shards.assign(docs, 5).collect()
    want = sorted((d is not None, d or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in odd_docs)
    assert [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in sorted(rows, key=lambda r: r.row_no)] == want
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts[s] for s in range(5)) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in counts)
    again = shards.assign(docs.repartition(2), 5).collect()
    assert key((r.row_no, r.shard, r.slot) for r in again) == key((r.row_no, r.shard, r.slot) for r in rows)
    assert shards.assign(no_docs, 5).count() == 0
    for n in (1, 2, 5, 17, 1000, 65_537):
        assert sorted(shards.permute(np.arange(n), n)) == list(range(n))
    assert (np.diff(shards.permute(np.arange(1000), 1000)) != 1).mean() > 0.9


# ---- quality


def test_quality(spark, docs, odd_docs, no_docs):
    import random

    rng = random.Random(1)
    word = lambda bad: "".join(rng.choice("abcdefgh") for _ in range(5)) + ("!!" if bad else "")
    rows = [(i, " ".join(word(i % 3 == 0) for _ in range(80)), int(i % 3 != 0)) for i in range(600)]
    train = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = train.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    model = quality.fit(train, labels)
    got = quality.score(train.select("doc_id", "text", "quality"), model).withColumn("held", quality.held_out(F.col("doc_id"))).filter("held").collect()
    assert len(got) > 100 and all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in got) >= 0.97 * len(got)
    odd = quality.score(docs, model).collect()  # its own column "score" is replaced
    assert len(odd) == len(odd_docs) and all(0 <= r.score <= 1 for r in odd)
    assert [c for c in quality.keep_good(docs, labels).columns] == docs.columns and quality.keep_good(docs, labels).filter("score <> 's'").count() == 0
    for r in odd:  # sizes by the plain compressor with the whole dictionaries, a block at a time
        d = (r.text or "").encode()
        cut = [d[i : i + 1024] for i in range(0, len(d), 1024)] or [b""]
        size = lambda k: sum(len(zstandard.ZstdCompressor(level=3, dict_data=k, write_content_size=False, write_dict_id=False, write_checksum=False).compress(b)) for b in cut)
        m = [(size(zstandard.ZstdCompressionDict(model.bad)) - size(zstandard.ZstdCompressionDict(model.good))) / max(len(d), 1), size(None) / max(len(d), 1)]
        z = sum(w * (x - c) / s for w, x, c, s in zip(model.weights, m, model.centre, model.scale)) + model.weights[-1]
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(train, flipped) == model  # held-out labels are never looked at
    assert quality.fit(train.unionByName(train), labels) == model  # repeated ids count once
    kept = quality.keep_good(train, labels)
    assert kept.columns == train.columns and kept.filter("quality = 1").count() > 380
    empty = quality.fit(no_docs, labels.limit(0))
    assert {r.score for r in quality.score(docs.drop("score"), empty).collect()} == {0.5} and quality.score(no_docs.drop("score"), empty).count() == 0


# ---- repeated lines


def told_by(rows):
    """By a chunk's name: the smallest document that has it and the lines beside it there, if two documents have it."""
    found, docs_of = {}, {}
    for doc, text in rows:
        seen = set()
        for spans, i, chunk in lines.chunks_of(text) if doc is not None else ():
            if chunk not in seen:
                found.setdefault(chunk, []).append((doc, *lines.beside(text.encode().split(b"\n"), spans, i)))
                docs_of.setdefault(chunk, set()).add(doc)
            seen.add(chunk)
    return {lines._name(c): min(v) for c, v in found.items() if len(docs_of[c]) > 1}


def test_line_dedup(spark, docs, odd_docs, no_docs):
    told = told_by([(d, t) for d, t, *_ in odd_docs])
    got = lines.drop_repeated(docs)
    assert got.columns == [*docs.columns, *lines.MADE]
    assert key(got.select("doc_id", "text", *lines.MADE).collect()) == Counter((d, *lines.remove(t, told, d)) for d, t, *_ in odd_docs)
    assert got.agg(F.sum("n_removed_lines")).first()[0] > 25
    assert lines.drop_repeated(no_docs).count() == 0
    clash = docs.withColumns({"n_lines": F.lit(-1), "N_removed_chunks": F.lit("x"), "n_removed_lines": F.lit(None).cast("int")})
    kept = lines.keep_lines(clash)
    assert kept.columns == clash.columns and kept.filter("n_chars <> length(text)").count() == 0
    assert kept.filter("n_lines <> -1 OR N_removed_chunks <> 'x' OR n_removed_lines IS NOT NULL").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "", " "]) | st.integers(0, 99).map(str), max_size=14), st.lists(st.integers(0, 99).map(str), min_size=2, max_size=12), st.lists(st.integers(0, 99).map(str), max_size=14))
def test_passages_are_cut_to_their_ends(before, shared, after):
    """Whatever chunk two texts share, the cut reaches as far as they agree around it, and never farther."""
    one, two = ["first", *shared, "last"], [*before, *shared, *after]
    told = told_by([(1, "\n".join(one)), (2, "\n".join(two))])
    kept = [x for x in lines.remove("\n".join(two), told, 2)[0].split("\n") if x or "" in two]
    gone = Counter(two) - Counter(kept)
    assert not Counter(kept) - Counter(two)
    if len(set(shared) | set(before) | set(after)) == len(shared) + len(before) + len(after) and all(x.strip() for x in before + after):
        assert not gone or gone == Counter(shared)  # all lines differ: the passage goes whole or not at all
    text, others = "\n".join(f"{i} {x}" for i, x in enumerate(shared * 6)), "\n".join(f"own {i}" for i in range(9))
    told = told_by([(1, "head\n" + text + "\ntail"), (2, others + "\n" + text)])
    assert lines.remove(others + "\n" + text, told, 2)[0] == (others if told else others + "\n" + text)


def test_chunks_decide(monkeypatch):
    passage = "\n".join(f"line {i} of a passage" for i in range(12))
    rows = [(1, "a\nb\n" + passage + "\nc"), (2, "d\n" + passage + "\ne\nf")]
    assert lines.remove(rows[1][1], told_by(rows), 2) == ("d\ne\nf", 15, 1, 12)
    monkeypatch.setattr(lines, "chunk_bounds", lambda found, family: [(0, len(found))])  # without content-defined bounds nothing is found
    assert lines.remove(rows[1][1], told_by(rows), 2)[0] == rows[1][1]


def test_line_chunks_move_with_text():
    rows = [f"line {i * i % 37}".encode() for i in range(200)]
    cuts = {rows[b - 1] + b"|" + rows[b - 2] for _, b in lines.chunk_bounds(rows)[1:-1]}
    moved = {r[b - 1] + b"|" + r[b - 2] for r in [[b"new", b"lines", *rows]] for _, b in lines.chunk_bounds(r)[2:-1]}
    assert len(cuts & moved) >= len(cuts) - 2


# ---- byte strings across documents


def brute_repeats(rows, width=50):
    least, out = {}, Counter()
    for doc, text, *_ in rows:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            s = b[i : i + width]
            d = 2**63 if doc is None else doc
            least[s] = min(d, least.get(s, d))
    for doc, text, *_ in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if least[b[i : i + width]] < (2**63 if doc is None else doc):
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(doc, len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_suffixes(docs, odd_docs, no_docs):
    assert key(suffixes.remove_repeats(docs).collect()) == brute_repeats(odd_docs)
    assert suffixes.remove_repeats(no_docs).count() == 0
    full = suffixes.remove_repeats(docs, spans=True).filter("doc_id = 6").first()
    assert full.spans == [[0, full.n_bytes]] and bytes(full.kept) == b""


def test_suffixes_with_common_markers(spark, monkeypatch):
    import random

    monkeypatch.setattr(suffixes, "HOT", 3)
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    passage = noise(120)
    rows = [(i, noise(rng.randrange(80)) + passage + noise(rng.randrange(80)) + noise(60)) for i in range(30)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert key(got) == brute_repeats(rows)
    monkeypatch.setattr(suffixes, "HOT", 4096)
    far = [(2**63 - 1, passage + noise(70)), (None, passage + noise(40)), (-(2**63), noise(60)), (2**63 - 2, noise(30) + passage), (5, "".join(passage[:40] + noise(30) for _ in range(6000))), (6, passage)]
    got = suffixes.remove_repeats(spark.createDataFrame(far, "doc_id long, text string")).collect()  # the largest id, and one text with one marker in thousands of contexts
    assert key(got) == brute_repeats(far)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.integers(2, 100))
def test_suffix_order(text, reach):
    order = suffixes.suffix_order(np.array(text), reach)
    heads = [text[i : i + reach] for i in order]
    assert sorted(order) == list(range(len(text))) and heads == sorted(heads)


# ---- fingerprints


def brute_sketch(text):
    """(size, cells): subtable, cell -> [count, digests, checks], by the definition of the sketch."""
    import re

    found = {xxhash.xxh64_intdigest(p.strip(" ").encode(), 42) for p in re.split(r"\n|(?<=[aeiou])\.", text)} - {xxhash.xxh64_intdigest(b"", 42)}
    size = max(4, max(2 * len(found) - 1, 1).bit_length())
    return size, found, dealt(found, size)


def hashed(digest, seed):  # Spark's xxhash64 of a long and an int
    step = xxhash.xxh64_intdigest(digest.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), step)


def dealt(found, size):
    cells = {}
    for d in found:
        for t in range(3):
            c = cells.setdefault((t, hashed(d, t) & ((1 << size) - 1)), [0, 0, 0])
            c[0], c[1], c[2] = c[0] + 1, c[1] ^ d, c[2] ^ hashed(d, 7)
    return cells


def parsed(print_):
    raw, cells = base64.b64decode(print_), {}
    for i in range(1, len(raw), 23):
        cells[raw[i], int.from_bytes(raw[i + 1 : i + 5])] = [int.from_bytes(raw[i + 5 : i + 7]), int.from_bytes(raw[i + 7 : i + 15]), int.from_bytes(raw[i + 15 : i + 23])]
    return raw[0], cells


def peeled(cells, size):
    """Digests of a sketch or difference, by sign; None if peeling stops."""
    cells, found = {k: list(v) for k, v in cells.items()}, {}
    while True:
        alone = next(((t, c) for (t, c), (n, key, mark) in cells.items() if abs(n) == 1 and hashed(key, 7) == mark), None)
        if alone is None:
            return found if not any(any(v) for v in cells.values()) else None
        n, key, mark = cells[alone]
        found[key] = n
        for t in range(3):
            c = cells.setdefault((t, hashed(key, t) & ((1 << size) - 1)), [0, 0, 0])
            c[0], c[1], c[2] = c[0] - n, c[1] ^ key, c[2] ^ mark


def likeness(one, other):
    """From two printed fingerprints alone: both brought to one size, subtracted, and peeled."""
    (s, a), (r, b) = parsed(one), parsed(other)
    size = max(s, r)
    lists = [peeled(a, s), peeled(b, r)]
    if None in lists:
        return None
    a, b = (dealt(x, size) if z != size else c for x, z, c in zip(lists, (s, r), (a, b)))
    zero = [0, 0, 0]
    diff = {k: [a.get(k, zero)[0] - b.get(k, zero)[0], a.get(k, zero)[1] ^ b.get(k, zero)[1], a.get(k, zero)[2] ^ b.get(k, zero)[2]] for k in {*a, *b}}
    d = peeled(diff, size)
    n = len(lists[0]) + len(lists[1])
    return None if d is None else (n - len(d)) / (n + len(d)) if n else 1.0


def brute_fingerprints(rows):
    rows = sorted((d is not None, d or 0, xxhash.xxh64_intdigest((t or "").encode(), 42) - (xxhash.xxh64_intdigest((t or "").encode(), 42) >> 63 << 64), t or "") for d, t, *_ in rows)
    out = Counter()
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for (known, doc, _, text), (*_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, e, x = (brute_sketch(t)[1] for t in (text, edited, after))
        out[(doc if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(like(a, e), 9), round(like(a, x), 9))] += 1
    return out


TOLD = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


def told(frame):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in frame.select(*TOLD).collect())


def test_fingerprints(docs, odd_docs, no_docs):
    want = brute_fingerprints(odd_docs)
    got = iblt.fingerprints(docs)
    assert told(got) == want
    rows = got.collect()
    fits = [likeness(r.fingerprint, r.edited_fingerprint) for r in rows]
    assert sum(f is not None for f in fits) >= len(fits) - 1  # a sketch of few digests may, rarely, not be listed
    assert all(f is None or f == pytest.approx(r.near_edited) for f, r in zip(fits, rows))
    of = {}
    for r in got.join(docs.select("doc_id", "text").filter("doc_id IS NOT NULL").distinct(), "doc_id").select("doc_id", "text", "fingerprint").collect():
        of.setdefault(r.text or "", set()).add(r.fingerprint)
    for text, prints in of.items():
        size, _, cells = brute_sketch(text)
        assert (size, cells) in [parsed(p) for p in prints]
    assert iblt.fingerprints(no_docs).count() == 0
    lone = iblt.fingerprints(docs.filter("doc_id = 4")).first()
    assert lone.near_next == 1.0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_fingerprints_of_next_documents_by_the_prints(spark):
    import random

    rng = random.Random(3)
    piece = lambda: " ".join(rng.choice(["rose", "tea", "sun", "blue", "oak"]) + str(rng.randrange(99)) for _ in range(4)) + rng.choice(["a.", "\n", " x. "])
    rows, last = [], ""
    for i in range(60):
        last = last + piece() if i % 3 else "".join(piece() for _ in range(rng.randrange(1, 40)))
        rows.append((i * 7, last))
    rows += [(10**17, "far away."), (-(10**17), "and before\nit"), *[(5000, "the same\nrow")] * 900, *[(None, "nothing")] * 300]  # outliers and repeats
    got = iblt.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert told(got) == brute_fingerprints(rows)
    by = {r.doc_id: r for r in got.collect()}
    fits = [(likeness(by[i * 7].fingerprint, by[i * 7 + 7].fingerprint), by[i * 7].near_next) for i in range(59)]
    assert sum(f is not None for f, _ in fits) >= 55 and all(f is None or f == pytest.approx(n) for f, n in fits)


def test_failed_peeling_is_retried(docs, odd_docs, monkeypatch):
    want = brute_fingerprints(odd_docs)
    monkeypatch.setattr(iblt, "PHASES", (0,))  # most pairs are left unpeeled, also by the larger sketches
    assert told(iblt.fingerprints(docs)) == want


# ---- near copies by shared shingles


def shingles_of(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + min(size, len(words))]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def jaccard_of(a, b, size=5):
    a, b = shingles_of(a, size), shingles_of(b, size)
    return len(a & b) / max(len(a | b), 1)


def test_near_copies_by_shared_shingles(spark, docs, no_docs):
    import random

    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for i in range(300):
        base = [word() for _ in range(rng.randrange(100, 400))]
        copy = list(base)
        for _ in range(len(base) // 60 if i < 250 else len(base) // 12):
            copy[rng.randrange(len(copy))] = word()
        rows += [(i, " ".join(base)), (1000 + i, " ".join(copy))]
    base = rows[0][1].split()
    rows += [(2000 + i, " ".join([*base[:i], "x", *base[i + 1 :]])) for i in range(90)]  # a large group of near copies
    alike = {i for i in range(300) if jaccard_of(rows[2 * i][1], rows[2 * i + 1][1]) >= 0.8}
    assert 200 < len(alike) < 290
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df, size=5, similarity=0.8).collect()}
    assert set(range(300)) <= kept and not kept & set(range(2000, 2090))
    assert kept >= {1000 + i for i in range(300) if i not in alike}  # nothing below the similarity goes
    assert len({1000 + i for i in alike} - kept) >= 0.97 * len(alike)
    thin = {r.doc_id for r in simhash.keep_one(df).collect()}
    assert len({1000 + i for i in alike} - thin) < 0.5 * len(alike)  # what two of 64 bits find
    assert simhash.keep_one(docs, 5, 0.8).columns == docs.columns and simhash.keep_one(no_docs, 5, 0.8).count() == 0
    assert simhash.keep_one(docs.filter("doc_id IS NULL"), 5, 0.8).count() == 3


def test_large_groups_lose_no_link(spark, monkeypatch):
    import random

    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(120):  # edits that put pairs on both sides of 0.8: no text links to all, and some to few
        copy = list(base)
        for _ in range(rng.randrange(2, 9)):
            copy[rng.randrange(len(copy))] = f"x{i}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard_of(rows[i][1], rows[j][1]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < 100
    sketched = df.select("doc_id", simhash._sketched(5)("text").alias("s")).select("doc_id", "s.*")

    def run():
        found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, size=5, similarity=0.8).collect()}
        return [found[i] for i in range(len(rows))]

    monkeypatch.setattr(simhash, "ALL_PAIRS", 10**6)
    whole = run()
    slots = simhash.slotted(sketched)
    met = simhash.meetings(slots)
    all_pairs = {tuple(r) for r in simhash.candidates(met, 0.8).collect()}
    monkeypatch.setattr(simhash, "ALL_PAIRS", 3)
    monkeypatch.setattr(simhash, "IN_BLOCK", 5)
    none = spark.createDataFrame([], "node long, root long")
    by_heads = {tuple(r) for r in simhash.candidates(met, 0.8).collect()}
    texts, nodes = df.withColumnRenamed("doc_id", "row"), sketched.withColumnRenamed("doc_id", "held")
    large = simhash.with_bitmaps(simhash.large_places(slots, none), texts, nodes, 5)
    left = {tuple(r) for r in simhash.open_pairs(large, 0.8).collect()}
    middle = {tuple(r) for r in simhash.central(large, 0.8).collect()}
    text_of = {r.fp: rows[r.doc_id][1] for r in sketched.collect()}
    alike = {(a, b) for a, b in all_pairs if jaccard_of(text_of[a], text_of[b]) >= 0.8}
    assert by_heads < all_pairs and alike - by_heads and alike <= by_heads | left <= all_pairs and middle <= all_pairs
    assert len(left - alike) < 0.2 * len(all_pairs - alike)  # the bound leaves few to the sets
    assert run() == whole
    assert sum(a != b for a, b in zip(whole, root)) <= 2 and all(root[i] == root[r] for i, r in enumerate(whole))


def test_bitmaps_bound_what_sets_share():
    rng = np.random.default_rng(3)
    for size in (1, 3, 40, 300, 5000):
        one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        frames = []
        for drop in (0, size // 20, size // 9, size // 2):
            two = np.unique(np.concatenate([one[drop:], rng.integers(0, 1 << 63, drop, dtype=np.uint64)]))
            frames.append({"size": len(two), "bits": 0, "bitmap": simhash.bitmap(two), "set": two})
        import pandas as pd

        left, right = pd.DataFrame([{"size": len(one), "bits": 0, "bitmap": simhash.bitmap(one)}]), pd.DataFrame(frames)
        found = {int(j) for _, js in simhash.bounded_pairs(left, right, 0.8) for j in js}
        shared = [len(np.intersect1d(one, f["set"])) for f in frames]
        alike = {j for j, (n, f) in enumerate(zip(shared, frames)) if n >= 0.8 * (len(one) + f["size"] - n)}
        assert alike <= found and 3 not in found or size < 3


def test_all_64_bits_of_two_simhashes_count():
    import pandas as pd

    one = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 90, dtype=np.uint64))
    of = lambda bits: pd.DataFrame([{"size": len(one), "bits": bits, "bitmap": simhash.bitmap(one)}])
    for a, b, near in ((0, 7 - 2**63, True), (-1, 2**63 - 8, True), (0, -(2**40), True), (0, 2**40 - 1, False), (0, -1, False)):  # 4, 4, 24, 40, 64 bits apart
        assert [j.tolist() for _, j in simhash.bounded_pairs(of(a), of(b), 0.8)] == ([[0]] if near else [])


def test_a_common_passage_makes_few_rows(spark):
    import random

    rng = random.Random(12)
    passage = [f"p{i}" for i in range(200)]
    rows = [(i, " ".join([*(f"t{i}_{j}" for j in range(rng.randrange(60, 90))), *passage])) for i in range(400)]  # alike in some 0.57
    for i in range(40):  # near copies of some of them
        words = rows[i][1].split()
        words[5] = words[-3] = f"edit{i}"
        rows.append((1000 + i, " ".join(words)))
    df = spark.createDataFrame(rows, "row long, text string").repartition(4)
    nodes = df.select(F.col("row").alias("held"), simhash._sketched(5)("text").alias("s")).select("held", "s.*")
    slots = simhash.slotted(nodes)
    assert slots.filter(F.col("n") > 100).count() > 400 and simhash.meetings(slots).count() <= simhash.SLICES * len(rows)
    left = simhash.partnered(slots, df, nodes, 5, 0.8)
    held = {r.held for r in left.filter(F.col("n") > simhash.ALL_PAIRS).join(nodes, "fp").select("held").collect()}
    assert held <= {*range(40), *range(1000, 1040)} and len(held) > 40  # texts with the passage alone are in no large place
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df.withColumnRenamed("row", "doc_id"), size=5, similarity=0.8).collect()}
    assert found == {i: i % 1000 if i >= 1000 else i for i, _ in rows}


def test_similar_sets_share_a_rare_shingle():
    rng = np.random.default_rng(6)
    counts = rng.integers(1, 9, simhash.COUNTERS).astype(np.int32)
    for size in (1, 2, 5, 9, 100, 333):
        one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for drop in range(size // 8 + 1):
            for more in (0, drop):
                two = np.unique(np.concatenate([one[drop:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
                shared = len(np.intersect1d(one, two))
                if shared >= 0.8 * (len(one) + len(two) - shared):
                    assert len(np.intersect1d(simhash.rare_first(one, counts, 0.8), simhash.rare_first(two, counts, 0.8)))


@pytest.mark.parametrize("clash", [{"__row": "x", "__score": "y", "__bpe": "z", "__from": "f"}])
def test_internal_names_give_way(spark, clash):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(60)), *clash.values()) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    for kept in (simhash.keep_one(df, 5, 0.8), quality.keep_good(df, labels), lines.keep_lines(df)):
        assert kept.columns == df.columns and kept.filter(" OR ".join(f"{c} <> '{v}'" for c, v in clash.items())).count() == 0
    done = bpe.encode_checked(df)
    assert set(df.columns) < set(done.columns) and done.filter("__bpe <> 'z' OR NOT exact").count() == 0


# ---- short passages in documents that else differ


def test_passages_are_cut_whole(spark):
    import random

    rng = random.Random(2)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(8))
    rows, want = [], {}
    for i in range(60):
        passage, own = [line() for _ in range(14 + i % 6)], [line() for _ in range(9)]
        rows += [(i, "\n".join([line(), line(), *passage, line()])), (1000 + i, "\n".join([*own[:4], *passage, *own[4:]]))]
        want[1000 + i] = ("\n".join(own), 1, len(passage))
    rows += [(3000, "\n".join([rows[0][1].split("\n")[0], "alone", rows[2][1].split("\n")[0]]))]  # single lines stay
    want |= {i: (t, 0, 0) for i, t in rows if i not in want}
    got = lines.drop_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_removed_chunks, r.n_removed_lines) for r in got} == want
    assert all(b - a > 1 for a, b in lines.chunk_bounds([b"%d" % i for i in range(100)])[:-1])
    assert lines.remove("x\nx\nx\ny", {}, 1)[0] == "x\nx\nx\ny"
    long = "\n".join(f"{i} {i * i}" for i in range(20))
    assert lines.remove(f"a\n{long}\nb\n{long}\nc", {}, 1) == (f"a\n{long}\nb\nc", 43, 1, 20)
