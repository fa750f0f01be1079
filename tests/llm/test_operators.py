"""Every corpus operator against brute force, and on awkward tables: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import collections
import hashlib
import io
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftlink.llm import bytewords, components, forest, linecrf, linededup, mixing, ngramjoin, packing, passages, queries, repetition, storage, tokens, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = [f"w{i}" for i in range(400)]


def words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edit_words(text, n, seed):
    r, ws = random.Random(seed), text.split(" ")
    for i in r.sample(range(len(ws)), n):
        ws[i] = f"x{r.randrange(10**6)}"
    return " ".join(ws)


BASE = words(120, 1)
PASSAGE = words(60, 2)
ROWS = [
    (1, BASE, "a"), (2, None, "a"), (3, "", "b"), (4, BASE, None), (4, BASE, None), (5, edit_words(BASE, 1, 3), "b"), (6, words(30, 4) + " " + PASSAGE, "c"),
    (7, PASSAGE + "\n" + words(40, 5), "c"), (8, "Ünïcode  wörds　and\x0btabs\t end\n\n", "a"), (9, words(30_000, 6), "hot"), (10, "one", "hot"), (11, "ONE", "hot"), (None, words(90, 7), "a"),
    (12, "\n".join(["a line that comes twice in this very text"] * 2 + [words(20, 8)]), "d"), (13, "\n".join(["A line that comes twice in this very text", words(25, 9)]), "d"),
    (14, " \n\t ", "d"), (15, "dup " * 60, "e"),
]
CLASH = ["size", "target", "node", "n", "key", "line", "rank", "piece", "length"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3).withColumn("lang", F.lit("en"))
    for c in CLASH:
        df = df.withColumn(c, F.lit(c))
    return storage.cut(df)


@pytest.fixture(scope="module")
def none(docs):
    return storage.cut(docs.where("false"))


def test_words_and_hashes():
    texts = [r[1] or "" for r in ROWS]
    data, borders = bytewords.buffers(pa.array([r[1] for r in ROWS]))
    starts, ends, first = bytewords.word_spans(data, borders)
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in WORD.findall(t)]
    assert list(np.diff(first)) == [len(WORD.findall(t)) for t in texts]
    hashes = bytewords.span_hashes(data, starts, ends)
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))


def thue_morse(levels):
    """Two different words that polynomial hashes modulo a power of two confuse."""
    a = "a"
    for _ in range(levels):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_thue_morse_words_apart():
    for levels in (2, 5, 7, 10, 13):
        x, y = thue_morse(levels)
        data, borders = bytewords.buffers(pa.array([x, y, x]))
        for which in (0, 1):
            h = bytewords.span_hashes(data, borders[:-1], borders[1:], which)
            assert h[0] != h[1] and h[0] == h[2]
        same = bytewords.spans_equal(data, borders[[0, 0]], data, borders[[1, 2]], np.diff(borders)[:2])
        assert same.tolist() == [False, True]
        w = bytewords.span_hashes(bytewords.buffers(pa.array(["a", "b"]))[0], np.array([0, 1]), np.array([1, 2]))
        runs, at = bytewords.window_hashes(np.array([w[int(c == "b")] for c in x + y], np.uint64), np.array([0, len(x), 2 * len(x)]), min(len(x), 50))
        assert runs[0] != runs[at.tolist().index(len(x))]


def test_operators_tell_thue_morse_words_apart(spark, tmp_path):
    x, y = thue_morse(10)
    texts = [f"{x} one two three", f"{y} one two three", "\n".join([x, y, x])]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, " ".join(x), "s"), (4, " ".join(y), "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    crc = {i: zlib.crc32(np.array(t.encode(x, add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, x, _ in rows}
    assert {r.doc_id: r.ids_crc32 for r in packing.pack_documents(df, queries.tokenizer_path(), 8192).collect()} == crc
    path = storage.fresh_path(spark, "shards")
    shards = packing.write_shards(df, path, queries.tokenizer_path(), 8192)
    assert {r.doc_id: r.ids_crc32 for r in packing.read_shards(spark, path, shards).collect()} == crc
    assert {r.doc_id: r.n_dup_lines for r in repetition.quality_rules(df).collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 0}
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in passages.drop_passages(df, size=2).collect())
    assert got == brute_passages(rows, 2)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.jaccard_groups(df, size=3, percent=40).collect())
    assert got == brute_groups(rows, 3, 40)


def test_op1_warc(spark, tmp_path):
    big, gz = "é" * 700, "\x1f?\x08" * 600
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate([big, big, None, "", "s", "s", gz, big + "x"])] + [(1, "u", big), (None, None, big), (None, "n", gz)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect())
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        revisit = len(b) >= 1000 and ids and max(ids) != i
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None)] += 1
    assert got == want
    assert warc.archive_round_trip(pages.where("false")).count() == 0


@pytest.mark.parametrize("size", [37, 501, 4096])
def test_op1_every_record_has_one_owner(size):
    """Any cut of an archive into ranges gives every record once, false magic numbers inside members notwithstanding."""
    r = random.Random(5)
    raw = bytearray()
    offsets = []
    for i in range(40):
        payload = bytes(r.randrange(256) for _ in range(r.randrange(600))) + b"\x1f\x8b\x08" * r.randrange(3)
        offsets.append(len(raw))
        raw += warc.record(i, "u", payload, "response", None, hashlib.sha1(payload).hexdigest(), "t")
    seen = [o for a in range(0, len(raw), size) for o, f, b in warc.records_in(io.BytesIO(bytes(raw)), a, min(a + size, len(raw)))]
    assert seen == offsets


def naive_best_fit(lengths, size):
    """Sequences that best-fit-decreasing opens, by looking at all of them for every piece."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(size - n)
    return len(gaps)


def test_op2_sweep_is_the_successor_rule(spark):
    """One round gives every unit, from the largest down, the least open gap that holds it."""
    r = random.Random(7)
    for n, tasks in ((0, 1), (30, 1), (300, 5)):
        gaps, units = [(r.randint(1, 20), i) for i in range(n)], [(r.randint(1, 20), i) for i in range(n)]
        rows = [(g, False, i, 0, 0) for g, i in gaps] + [(u, True, u, i, 1) for u, i in units]
        got = packing.sweep(spark.createDataFrame(rows, packing._STATE), tasks).collect()
        met = collections.Counter((x.size, x.by_size) for x in got if x.unit and x.by is not None)
        assert collections.Counter((x.by_size, x.size) for x in got if not x.unit and x.by is not None) == met
        left, want = [g for g, _ in gaps], collections.Counter()
        for u in sorted((u for u, _ in units), reverse=True):
            fit = [g for g in left if g >= u]
            if fit:
                left.remove(min(fit))
                want[(u, min(fit))] += 1
        assert met == want and len({x.by for x in got if x.unit and x.by is not None}) == sum(met.values())


@pytest.mark.parametrize("trial", range(3))
def test_op2_places_every_piece(spark, trial):
    r = random.Random(trial)
    size = (16, 64, 256)[trial]
    lengths = [min(size, r.choice([r.randint(1, size), r.randint(1, 6), 3])) for _ in range((0, 900, 300)[trial])]
    places = packing.best_fit_places(spark, dict(collections.Counter(lengths)), size, size // 16).collect()
    use, got = collections.defaultdict(list), collections.Counter()
    for p in places:
        for k in range(p.m):
            got[(p.length, p.rank + k)] += 1
            use[p.sequence_id + (k if p.offset < 0 else 0)].append((max(p.offset, 0) + (p.length * k if p.offset >= 0 else 0), p.length))
    assert sorted(got) == sorted((n, k) for n, c in collections.Counter(lengths).items() for k in range(c)) and set(got.values()) <= {1}
    for placed in use.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= size
    assert len(use) <= 1.05 * naive_best_fit(lengths, size) + 1


def test_op7_tree_finds_the_least_gap():
    r = random.Random(9)
    for size in (1, 7, 64, 100):
        tree, open_ = packing.CapacityTree(size), []
        for i in range(400):
            if r.random() < 0.6:
                gap = r.randint(1, size)
                tree.add(gap, i)
                open_.append(gap)
            else:
                need = r.randint(1, size)
                fit = [g for g in open_ if g >= need]
                found = tree.take(need)
                assert (found[0] if found else None) == (min(fit) if fit else None)
                if fit:
                    open_.remove(min(fit))
    for trial in range(30):
        lengths = np.array([r.randint(1, 50) for _ in range(r.randint(0, 120))], np.int64)
        seq, offset, n = packing.best_fit_decreasing(lengths, 50)
        assert n == naive_best_fit(lengths.tolist(), 50)


def reference_pieces(seq_len):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    out = collections.Counter()
    for i, text, _ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        n = -(-len(ids) // seq_len)
        cuts = [0] + [len(ids) - (n - 1 - k) * seq_len for k in range(n)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    return out


def check_places(rows, seq_len, by):
    use = collections.defaultdict(list)
    for r in rows:
        use[by(r)].append((r.offset, r.length))
    for placed in use.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= seq_len


def test_op2_and_op7_pieces(spark, docs, none):
    for seq_len in (64, 2048):
        rows = packing.pack_documents(docs, queries.tokenizer_path(), seq_len).collect()
        assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == reference_pieces(seq_len)
        check_places(rows, seq_len, lambda r: r.sequence_id)
    path = storage.fresh_path(spark, "shards")
    manifest = packing.write_shards(docs, path, queries.tokenizer_path(), 64, shard_tokens=5000)
    rows = packing.read_shards(spark, path, manifest).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == reference_pieces(64)
    check_places(rows, 64, lambda r: (r.shard, r.sequence_id))
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0
    assert packing.read_shards(spark, path, packing.write_shards(none, path, queries.tokenizer_path())).count() == 0


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    r = random.Random(2)
    texts = ["", " ", "a  b\n\n c", "　x   y", "<|endoftext|> 's 'll\n's", "\x1c a\x1f  b"] + ["".join(r.choice([" ", "\n", "a", "é", "7", "!", "'s", " ", "的"]) for _ in range(30)) for _ in range(500)]
    got = [ids[a:b].tolist() for _, _, ids, at in tokens.encoded(pa.array(texts), queries.tokenizer_path(), None) for a, b in zip(at[:-1], at[1:])]
    assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def repeats(ws):
    n = len(ws)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and ws[i + k] == ws[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_op3_suffix_array():
    r = random.Random(1)
    for _ in range(150):
        texts = [" ".join(r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(0, 25))) for _ in range(r.randint(1, 4))]
        data, borders = bytewords.buffers(pa.array(texts))
        starts, ends, first = bytewords.word_spans(data, borders)
        found = repetition.suffix_repeats(bytewords.span_hashes(data, starts, ends), np.repeat(np.arange(len(texts)), np.diff(first)))
        assert found.tolist() == [x for t in texts for x in repeats(t.split())]


def test_op3_rules(docs, none):
    rows = repetition.quality_rules(docs).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r[0] for r in ROWS)
    by = {r.doc_id: r for r in rows}
    assert (by[2].n_words, by[2].base_failed, by[2].kept) == (0, True, False) and by[15].base_failed and not by[15].kept
    assert by[1].kept and by[9].kept and by[9].n_words == 30_000 and by[12].n_dup_lines == 1 and by[14].n_dup_lines == 0
    twice = words(30, 20) + " " + words(400, 21) + " " + words(30, 20) + " " + words(30, 22)
    r = repetition.quality_rules(docs.limit(1).select(F.lit(1).alias("doc_id"), F.lit(twice).alias("text")), max_covered_percent=20, max_passage=20).first()
    assert r.longest_repeat >= 30 and not r.base_failed and not r.kept
    assert repetition.quality_rules(none).count() == 0


def test_op4_mix(docs, none, spark):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(ROWS) and rows and sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    sizes = collections.Counter()
    for i, t, s in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, total = set(names), {}, float(sum(sizes.values()))
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    target |= {s: weight[s] * level for s in left}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.copies <= 3
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise(F.concat(F.lit("y"), F.col("id") % 7)).alias("source"))
    taken = mixing.mix_sources(many).groupBy("source").agg((F.sum(F.col("size") * F.col("copies")) / F.max("target")).alias("q"))
    assert all(abs(r.q - 1) < 0.15 for r in taken.collect())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_op5_near_lines(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcé ñ") for _ in range(r.randint(9, 22))) for _ in range(20)]

    def typo(s):
        s = list(s)
        for _ in range(r.randint(0, 4)):
            i, k = r.randrange(len(s)), r.random()
            s[i : i + 1] = [] if k < 0.3 and len(s) > 1 else [r.choice("abcé")] if k < 0.6 else [s[i], r.choice("abcé")]
        return "".join(s)

    rows = [(i, "\n".join(typo(r.choice(base)) for _ in range(r.randint(1, 6)))) for i in range(50)]
    lines = sorted({x for _, t in rows for x in t.split("\n") if len(x) >= 9})
    pairs = [(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :] if edits(a, b) <= 2]
    want = {x: x for x in lines}
    for a, b in pairs:
        a, b = want[a], want[b]
        want = {x: min(a, b) if g in (a, b) else g for x, g in want.items()}
    texts, edges = linededup.near_lines(spark.createDataFrame(rows, "doc_id long, text string"), 9, 2)
    line = {x.node: x.line for x in texts.collect()}
    found = {(line[e.a], line[e.b]) for e in edges.collect()}
    assert found and all(edits(a, b) <= 2 for a, b in found)
    got = {x: x for x in lines}
    for a, b in found:
        a, b = got[a], got[b]
        got = {x: min(a, b) if g in (a, b) else g for x, g in got.items()}
    assert got == want and len(set(want.values())) < len(lines)


def test_op5_long_lines(spark):
    pairs = [("x" * 40 + "e" * 255, "x" * 40 + "e" * 256), ("a" * 300 + "İ" * 40, "a" * 300 + "İ" * 39 + "i")]
    r = random.Random(6)
    for _ in range(200):
        a = [r.choice("etaoin shrdlu") for _ in range(r.randint(2500, 4000))]
        b = list(a)
        for _ in range(2):
            b[r.randrange(len(b))] = r.choice("etaoin shrdlu")
        pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) if p[0] != p[1] for k, x in enumerate(p)], "doc_id long, text string")
    assert linededup.near_lines(df)[1].count() == df.count() // 2


def test_op5_short_lines(spark):
    rows = [(1, "Menu\n\nRead more here\nabc"), (2, "Menu\n\nRead mere here!\nabd"), (3, "  \nabc\nMenus\n" + " " * 8), (4, "\n  ")]
    got = {r.doc_id: r.removed for r in linededup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "0,2", 3: "1", 4: ""}


def test_op5_keeps_what_is_left(spark):
    rows = [(1, words(300, 20)), (2, words(300, 20) + "\nfound nowhere else"), (3, words(300, 20) + "\n \n")]
    kept = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in kept} == {1: rows[0][1], 2: "found nowhere else"}


def test_op5_heavy_and_near_copies(spark, monkeypatch):
    """A line that most documents have, one that most have with an edit, and rows that are no near copies of these."""
    monkeypatch.setattr(linededup, "HEAVY", 20)
    r = random.Random(12)
    common, base = "one line that nearly every document of the corpus has", "seen by 0000 readers since the day it was first published"
    rows = [(i, f"{common}\n{base.replace('0000', f'{i % 40:04d}')}\n{words(12, 700 + i)}\n{common if r.random() < 0.2 else words(3, 900 + i)}") for i in range(300)]
    want = {}
    kept = []
    for i, t in rows:
        gone = []
        for k, x in enumerate(t.split("\n")):
            if x in kept or any(abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2 for y in kept[-40:] + kept[:4]):
                gone.append(str(k))
            else:
                kept.append(x)
        want[i] = ",".join(gone)
    got = {x.doc_id: x.removed for x in linededup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want and len(want[299].split(",")) >= 2


def test_op5_cases(docs, none):
    by = collections.defaultdict(list)
    for r in linededup.line_report(docs).collect():
        by[r.doc_id].append((r.n_lines, r.n_removed, r.removed))
    assert len([x for v in by.values() for x in v]) == len(ROWS)
    assert by[1] == [(1, 0, "")] and by[2] == [(0, 0, "")] and by[4] == [(1, 1, "0")] * 2 and by[12] == [(3, 1, "1")] and by[13] == [(2, 1, "0")]
    kept = linededup.dedup_lines(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert 4 not in texts and texts[2] is None and texts[13] == words(25, 9) and texts[1] == BASE
    assert linededup.dedup_lines(none).count() == 0


def test_op6_forest(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((700, 16))
    near = [v[i] * 0.5 + 0.1 * rng.standard_normal(16) for i in range(60)]
    clump = [v[100] + 0.12 * rng.standard_normal(16) for _ in range(150)]
    vectors = [x.tolist() for x in [*v, *near, *clump]] + [v[5].tolist()] * 40 + [(3 * v[6]).tolist()]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0]]
    rows = [(i, x, "l") for i, x in enumerate(vectors + odd)] + [(0, vectors[0], "l"), (None, vectors[1], "l")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("u", F.lit(1)).withColumn("node", F.lit(1))
    got = forest.near_vectors(df, leaf=64).collect()
    assert len(got) == len(rows)
    m = np.array([x for x in vectors])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    links = m @ m.T >= 0.9
    np.fill_diagonal(links, False)
    want = links.sum(1) + links[:, 0] + links[:, 1]  # the repeated row and the one without an id
    want[0] += 1
    want[1] += 1
    by = {r.vec_id: r for r in got if r.vec_id not in (0, None)}
    found = sum(by[i].n_links for i in range(1, len(vectors)))
    assert found <= want[1:].sum() and found >= 0.97 * want[1:].sum()
    assert all(by[i].n_links <= want[i] for i in range(1, len(vectors)))
    comp = list(range(len(vectors)))
    for i, j in zip(*np.nonzero(links)):
        a, b = comp[i], comp[j]
        if a != b:
            comp = [min(a, b) if c in (a, b) else c for c in comp]
    assert np.mean([by[i].component_id == comp[i] for i in range(1, len(vectors))]) > 0.99
    n = len(vectors)
    assert all(by[n + k].n_links == 0 and by[n + k].kept for k in range(6)) and by[n + 6].n_links == by[n + 7].n_links == 1
    assert forest.near_vectors(df.where("false")).count() == 0


def links_against_brute(spark, v, **kw):
    """Found and true sums of n_links."""
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    return sum(r.n_links for r in forest.near_vectors(df, **kw).collect()), int((u @ u.T >= 0.9).sum()) - len(v)


def test_op6_two_lengths(spark):
    """Vectors of every length are compared, with their like only."""
    rng = np.random.default_rng(11)
    rows, want = [], {}
    for dims, n in ((24, 300), (6, 60), (3, 30)):
        base = rng.standard_normal((n // 2, dims))
        v = np.vstack([base, base + 0.02 * rng.standard_normal(base.shape)])
        u = v / np.linalg.norm(v, axis=1, keepdims=True)
        for i, c in enumerate((u @ u.T >= 0.9).sum(1) - 1):
            want[len(rows)] = int(c)
            rows.append((len(rows), v[i].tolist()))
    got = {r.vec_id: r.n_links for r in forest.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), leaf=64).collect()}
    assert sum(got.values()) >= 0.99 * sum(want.values()) and all(got[i] <= want[i] for i in want) and all(got[i] >= 1 for i in got)


def test_op6_large_clump(spark):
    rng = np.random.default_rng(8)
    clump = rng.standard_normal(64) + 0.3 * rng.standard_normal((2500, 64))
    got, want = links_against_brute(spark, np.vstack([rng.standard_normal((1500, 64)), clump]), trees=2, leaf=64)
    assert want > 1e6 and 0.999 * want <= got <= want


def brute_passages(rows, size):
    first = {}
    for i, t, _ in rows:
        ws = WORD.findall(t or "")
        for k in range(len(ws) - size + 1) if i is not None else ():
            w = tuple(ws[k : k + size])
            first[w] = min(first.get(w, i), i)
    out = collections.Counter()
    for i, t, _ in rows:
        ws = WORD.findall(t or "")
        gone = {j for k in range(len(ws) - size + 1) if i is not None and first[tuple(ws[k : k + size])] < i for j in range(k, k + size)}
        out[(i, len(ws), len(gone), " ".join(w for j, w in enumerate(ws) if j not in gone))] += 1
    return out


def test_op8_passages(docs, none):
    for size in (5, 50):
        got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in passages.drop_passages(docs, size=size).collect())
        assert got == brute_passages(ROWS, size)
    assert passages.drop_passages(none).count() == 0


def test_op8_many_blocks(docs, monkeypatch):
    """Blocks of one document, of which three meet at a time."""
    from weftlink.llm import blocks

    monkeypatch.setattr(passages, "MEET", 3)
    monkeypatch.setattr(blocks.write, "__defaults__", (1,))
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in passages.drop_passages(docs, size=5).collect())
    assert got == brute_passages(ROWS, 5)


def test_op9_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    chain = linecrf.Chain(rng.standard_normal(3), rng.standard_normal((2, 2)))
    x = rng.standard_normal((9, 3))
    first = np.array([0, 4, 5, 9])
    got = chain.marginals(x, first)
    for a, b in zip(first, first[1:]):
        emit, total, good = x[a:b] @ chain.weights, 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            y = [(code >> k) & 1 for k in range(b - a)]
            p = np.exp(sum(e for e, k in zip(emit, y) if k) + sum(chain.moves[p, q] for p, q in zip(y, y[1:])))
            total += p
            good += p * np.array(y)
        assert np.allclose(got[a:b], good / total)


def test_op9_long_words_weigh_their_bytes():
    data, borders = bytewords.buffers(pa.array(["語" * 100 + "\n" + "語" * 10_000 + "\nab cd"]))
    assert linecrf.line_features(data, borders)[1].tolist() == [300, 30_000, 4]


def test_op9_learns_and_handles_cases(spark, docs, none):
    r = random.Random(4)
    rows, marks = [], []
    for i in range(300):
        good = r.random() < 0.7
        text = "\n".join(words(r.randint(5, 30), i * 10 + k) for k in range(r.randint(1, 5)))
        rows.append((i, text if good else re.sub(" ", "!! ", text.upper())))
        marks.append((i, int(good)))
    table, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*marks, (None, 1), (1000, None)], "doc_id long, quality int")
    chain = linecrf.train(table, labels)
    score = {x.doc_id: x.score for x in linecrf.score_documents(table, chain).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(score[i] >= 0.5) == dict(marks)[i] for i in held]) > 0.95
    odd = linecrf.score_documents(docs, chain).collect()
    assert len(odd) == len(ROWS) and all(0 <= x.score <= 1 for x in odd)
    assert linecrf.score_documents(none, linecrf.train(none, labels.where("false"))).count() == 0
    assert linecrf.keep_good(docs, chain).columns == docs.columns


def brute_groups(rows, size, percent):
    sets = []
    for _, t, _ in rows:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} if len(ws) >= size else {tuple(ws)} if ws else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return collections.Counter((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))


def test_op10_groups(spark, docs, none):
    more = [(100 + k, edit_words(BASE, k % 7, 50 + k), "z") for k in range(40)] + [(200 + k, edit_words(words(60, 70), k % 4, 90 + k), "z") for k in range(25)]
    table = storage.cut(docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string")))
    for size, percent in ((3, 90), (5, 80)):
        got = ngramjoin.jaccard_groups(table, size=size, percent=percent).collect()
        assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(ROWS + more, size, percent)
    kept = ngramjoin.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 4 not in ids and {1, 2, 3, 6, 7, 9, 14} <= set(ids) and ids.count(None) == 1
    assert ngramjoin.jaccard_groups(none).count() == 0


def test_op8_and_op10_on_tables_that_are_no_files(spark, tmp_path):
    """Local rows, a join, and scans whose partitions change between the call and the action give the same results."""
    rows = [(i, t, s) for i, t, s in ROWS if i not in (9, None)] + [(300 + k, edit_words(BASE, k % 3, 500 + k), "z") for k in range(20)]
    local = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("file", F.lit(1)).withColumn("block", F.lit("x")).withColumn("salt", F.lit("y"))
    halves = local.drop("text").join(spark.createDataFrame([(i, t, s) for i, t, s in set(rows)], "doc_id long, text string, source string"), ["doc_id", "source"])
    many = str(tmp_path / "docs")
    local.repartition(7).write.parquet(many)
    scan = spark.read.parquet(many)
    want8, want10 = brute_passages(rows, 5), brute_groups(rows, 3, 90)
    for df in (local, halves, scan):
        own = rows if df is not halves else [(r.doc_id, r.text, r.source) for r in halves.collect()]
        if df is halves:
            want8, want10 = brute_passages(own, 5), brute_groups(own, 3, 90)
        elif df is scan:
            want8, want10 = brute_passages(rows, 5), brute_groups(rows, 3, 90)
        a, b, c = passages.drop_passages(df, size=5), ngramjoin.jaccard_groups(df, size=3, percent=90), ngramjoin.one_of_each(df, size=3, percent=90)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in a.collect()) == want8
            assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in b.collect()) == want10
            assert c.columns == df.columns and c.count() == b.where("leader").count()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_op10_common_shingle(spark):
    """A shingle that ten thousand unlike texts hold enters no prefix: it is last in the global order."""
    line = "all rights are reserved here"
    rows = [(i, f"{words(12, 3000 + i // 2)} q{i // 2} {line} {words(12, 90_000 + i // 2)}") for i in range(10_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    from weftlink.llm import blocks

    sets = ngramjoin.ordered_sets(blocks.write(df), 5, 80)
    top = sets.select(F.explode("keys").alias("k")).groupBy("k").count().orderBy(F.desc("count")).first()
    assert top["count"] == 10_000 and sets.where(F.element_at("keys", -1) != top["k"]).count() == 0
    got = {r.doc_id: r.component_id for r in ngramjoin.jaccard_groups(df, size=5, percent=80).collect()}
    assert got == {i: i // 2 * 2 for i in range(10_000)}


def test_blocks_keep_every_row(spark):
    from weftlink.llm import blocks

    df = spark.createDataFrame([(i, "x" * (i * 37 % 5000) if i % 5 else None) for i in range(3000)], "doc_id long, text string").repartition(3)
    for size in (1, 10_000, 1 << 20):
        b = blocks.write(df, size)
        got = collections.Counter((r.doc_id, r.text) for r in blocks.each(b, lambda n, x: iter([x]), df.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")).collect())
        assert got == collections.Counter((r.doc_id, r.text) for r in df.collect()) and b.rows == 3000
    assert blocks.write(df.where("false")).count == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(60).select((F.col("id") + 5).alias("a"), (F.col("id") + 6).alias("b")).unionByName(spark.createDataFrame([(900, 901), (900, 900)], "a long, b long"))
    got = {r.id: r.component for r in components.connected(edges).collect()}
    assert got == {**{i: 5 for i in range(5, 66)}, 900: 900, 901: 900}


def written_tables(monkeypatch):
    """Kinds of the tables that storage.cut writes from now on."""
    kinds, cut = [], storage.cut
    monkeypatch.setattr(storage, "cut", lambda df, kind="cut", by=None: (kinds.append(kind), cut(df, kind, by))[1])
    return kinds


#: Nodes of plans that run Python on the executors.
PYTHON = re.compile("Arrow|Pandas|Python")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written_plans(monkeypatch):
    """Plans of the tables that storage.cut writes from now on."""
    plans, cut = [], storage.cut
    monkeypatch.setattr(storage, "cut", lambda df, kind="cut", by=None: (plans.append(plan(df)), cut(df, kind, by))[1])
    return plans


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    """Few edges are joined by one task: a table of edges is written and no rounds; rounds give the same."""
    r = random.Random(4)
    rows = [(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(250)] + [(i, 5000) for i in range(1000, 1100)] + [(i, i + 1) for i in range(2000, 2100)] + [(7, 7), (None, 8)]
    kinds = written_tables(monkeypatch)
    for kind in ("long", "int"):
        edges = spark.createDataFrame(rows, f"a {kind}, b {kind}").repartition(5)
        kinds.clear()
        found = components.connected(edges)
        got = {x.id: x.component for x in found.collect()}
        assert kinds == ["edges"] and dict(found.dtypes) == {"id": edges.dtypes[0][1], "component": edges.dtypes[0][1]}
        with monkeypatch.context() as m:
            m.setattr(components, "FEW", -1)
            assert got == {x.id: x.component for x in components.connected(edges).collect()} and len(kinds) > 3
    assert got[1099] == 1000 and got[2100] == 2000
    assert components.connected(edges.where("false")).count() == 0


def test_components_without_python(spark, monkeypatch):
    """native=True runs no Python: a round of few edges is one task without an exchange, and gives what the one task of Python and the rounds of many give."""
    r = random.Random(4)
    rows = [(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(250)] + [(i, 5000) for i in range(1000, 1100)] + [(i, i + 1) for i in range(2000, 2100)] + [(7, 7), (None, 8)]
    for kind in ("long", "int"):
        edges = spark.createDataFrame(rows, f"a {kind}, b {kind}").repartition(5)
        want = {x.id: x.component for x in components.connected(edges).collect()}
        for few in (components.FEW, 300, -1):  # in one task at once, after some rounds, never
            with monkeypatch.context() as m:
                m.setattr(components, "FEW", few)
                plans = written_plans(m)
                found = components.connected(edges, native=True)
                rows_of = [(x.id, x.component) for x in found.collect()]
            assert dict(rows_of) == want and len(rows_of) == len(want) and not any(PYTHON.search(p) for p in [*plans, plan(found)])
            assert dict(found.dtypes) == {"id": edges.dtypes[0][1], "component": edges.dtypes[0][1]}
            if few > 300:
                assert len(plans) > 2 and not any("Exchange" in p for p in [*plans[1:], plan(found)])
    assert components.connected(edges.where("false"), native=True).count() == 0


def test_op5_runs_no_python(spark, docs, monkeypatch):
    plans = written_plans(monkeypatch)
    for made in (linededup.line_report(docs), linededup.dedup_lines(docs)):
        assert made.count() > 0 and len(plans) > 10 and not any(PYTHON.search(p) for p in [*plans, plan(made)])


def test_op2_round_of_few_rows_is_one_task(spark, monkeypatch):
    """A round of a single range neither looks for borders nor writes ranges: its totals are one window's."""
    kinds = written_tables(monkeypatch)
    rows = [(9, False, 0, 0, 0), (5, False, 1, 0, 0), (4, True, 4, 0, 1), (7, True, 7, 0, 1)]
    got = packing.sweep(spark.createDataFrame(rows, packing._STATE), 1)
    assert kinds == ["round"] and sorted((x.size, x.by_size) for x in got.collect() if x.unit) == [(4, 5), (7, 9)]


def test_storage_reads_the_sessions_folder(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert os.path.isdir(storage.cut(spark.range(1))._weftlink_path.removeprefix("file://"))
