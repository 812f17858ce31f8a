"""Line deduplication, phrase mining and whitening against plain versions."""

import hashlib
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from samples import TEXTS, documents, ordered  # noqa: E402

from bidlift.llm import lines, phrases, whitening  # noqa: E402

SMALL = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# lines


def plain_lines(docs, least=10):
    first = {}
    rows = [(-(1 << 63) if i is None else i, i, (t or "").split("\n")) for i, t in docs]
    for k, _, parts in rows:
        for line in parts:
            key = lowered(line.strip(BLANKS))
            first[key] = min(first.get(key, k), k)
    out = []
    for k, i, parts in rows:
        keys = [lowered(line.strip(BLANKS)) for line in parts]
        kept = [line for line, key in zip(parts, keys) if len(key) < least or first[key] == k]
        out.append((i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


LINES = [
    (4, "Shared licence line\nown line of the fourth\n\n"), (2, "  SHARED licence LINE\t\nshort\nown line of the second"), (9, "short\nshort\nshort"),
    (7, "shared licence line\nshared licence line\nown line of the second\r\nÉtat des lieux"), (8, "état des lieux\nÉtat des lieux"),
    (None, "a line of no document\nshared licence line"), (None, "a line of no document"), (3, "a line of no document"), (5, "\n"), (6, None),
    (7, "own line of the fourth\nshared licence line"), (7, "own line of the fourth\nshared licence line"), (10, "x\n" * 3000 + "shared licence line"),
]


@pytest.mark.parametrize("texts", [TEXTS, LINES, LINES + TEXTS])
def test_lines_equal_brute_force(spark, texts):
    docs = documents(spark, texts)
    assert ordered(lines.deduped(docs).collect()) == ordered(plain_lines(texts))


def test_lines_of_real_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ordered(lines.deduped(docs).collect()) == ordered(plain_lines(rows))


def test_hot_line_over_many_tasks(spark):
    """One line in every document, sorted into more tasks than it has rows to fill."""
    rows = [(i, f"the line that all documents share\nline number {i % 70} of some\n" + "the line that all documents share\n" * (i % 3)) for i in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = lines.deduped(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ordered(got) == ordered(plain_lines(rows))


def test_stream_carries_runs_over_batches():
    import pyarrow as pa

    rows = sorted((h, h, d, 0, p) for h in (1, 2, 3) for d in range(5) for p in range(2))
    def batches(size):
        for i in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[i : i + size]], pa.int32() if c == 4 else pa.int64()) for c in range(5)], list("hldpi"))
    for size in (1, 3, 10, 100):
        out = [tuple(r.values()) for b in lines._stream(batches(size)) for r in b.to_pylist()]
        assert sorted(r[1:6] for r in out if r[0] == lines.DROP) == [r for r in rows if r[0] > 1 and r[2] > 0]
        assert sorted(r[1:6] for r in out if r[0] == lines.OPEN) == [r for r in rows if r[0] == 1]
        assert [(r[1], r[6]) for r in out if r[0] == lines.LAST] == [(3, 0)]


def test_bitmaps():
    for n, dropped in ((1, [0]), (9, [8]), (20, [3, 5]), (64, list(range(64))), (100, [7])):
        kept = lines.unpack_bits(lines.pack_bits(np.array(dropped)), n)
        assert len(kept) == n and [i for i in range(n) if not kept[i]] == dropped


def test_dedup_of_texts(spark):
    docs = documents(spark, LINES)
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (6, None) in texts and (2, "  SHARED licence LINE\t\nshort\nown line of the second") not in texts
    assert (10, "x\n" * 3000 + "shared licence line") not in texts
    # A second run finds nothing more, but for documents without an id, which share one.
    assert lines.deduped(out).agg({"n_dropped": "sum"}).first()[0] == 0
    assert lines.dedup_lines(documents(spark, [])).count() == 0 and lines.deduped(documents(spark, [])).count() == 0


# phrases


def plain_phrases(docs, least, top=2000, covered=80):
    f, n, first = defaultdict(Counter), Counter(), {}
    for i, lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for s in range(len(w) - k + 1):
                    g = tuple(w[s : s + k])
                    f[lang][g] += 1
                    if i is not None:
                        first[lang, g] = min(first.get((lang, g), i), i)
    out = []
    for lang, counts in f.items():
        longer = defaultdict(int)
        good = [g for g, a in counts.items() if a >= least and len(g) > 1]
        for g in good:
            for k in range(2, len(g)):
                for s in range(len(g) - k + 1):
                    longer[g[s : s + k]] = max(longer[g[s : s + k]], counts[g])
        rows = []
        for g in good:
            a = counts[g]
            if longer[g] and 100 * longer[g] >= covered * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), l, r, first.get((lang, g))))
        for rank, (s, a, phrase, l, r, doc) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s, doc))
    return out


PHRASES = [
    (1, "en", "New York, new\tyork!  New  York city. " * 4), (2, None, "a b a b a b a b;a b c d e. " * 6), (3, "und", "a b c d e f" * 5),
    (None, "en", "new york city hall: old hall"), (4, "en", None), (5, "en", ""), (6, "fr", "É é É é. É é " * 9 + "x" * 5000), (7, "en", ".,;:!?\n\r"),
    (8, "fr", "漢字 𝒳𝒴 漢字 𝒳𝒴 " * 8), (1, "en", "New York, new\tyork!  New  York city. " * 4), (9, "en", "q " * 60),
]


def phrase_docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, lang string, text string, words int, phrase string")


@pytest.mark.parametrize("least,top,bits", [(2, 2000, 26), (3, 4, 20), (2, 2000, 6)])
def test_phrases_equal_brute_force(spark, least, top, bits):
    """Also with a table of 64 bits, which lets nearly everything through."""
    got = phrases.collocations(phrase_docs(spark, PHRASES), least=least, top=top, filter_bits=bits)
    assert ordered(got.collect()) == ordered(plain_phrases(PHRASES, least, top))


def test_phrases_in_small_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(phrases, "HELD", 1000)
    assert ordered(phrases.collocations(docs, least=5).collect()) == ordered(plain_phrases(rows, 5))


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    """With three bits of fingerprint nearly all phrases collide; the text keeps them apart."""
    monkeypatch.setattr(phrases, "mixed", lambda h: h & np.uint64(7))
    got = phrases.collocations(phrase_docs(spark, PHRASES), least=2)
    assert ordered(got.collect()) == ordered(plain_phrases(PHRASES, 2))


def test_phrases_of_nothing(spark):
    assert phrases.collocations(phrase_docs(spark, [])).count() == 0
    assert phrases.collocations(phrase_docs(spark, PHRASES[4:6])).count() == 0


def test_spans_of_a_prefix_polynomial():
    values = np.random.default_rng(3).integers(0, 300, 500).astype(np.uint64)
    values[300:320] = values[10:30]
    p = phrases.Polynomial(phrases.BYTE_BASE)
    start = np.array([10, 300, 11, 301, 0, 499])
    end = np.array([30, 320, 30, 320, 500, 500])
    h = p.spans(values, start, end)
    assert h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 4
    want = sum(int(v) * pow(phrases.BYTE_BASE, j, 1 << 64) for j, v in enumerate(values[11:30])) % (1 << 64)
    assert int(h[2]) == want


# whitening


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, [2.0]) for r in rows], "vec_id bigint, embedding array<float>, n int, x array<double>")


def check_whitening(got, rows, components=16):
    """Against an eigendecomposition of the covariance."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    size = Counter(len(v) for _, v in good).most_common(1)[0][0]
    grid = [(i, np.floor(64 * v).astype(np.int64) + 1000000) for i, v in good if len(v) == size]
    fit = np.unique(np.array([x for _, x in grid]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    assert len(got) == k * len(grid)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id, r.deviation].append(r)
        assert r.n == n and abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-9 * r.explained and r.identity_error < 1e-9
    sign = {}
    for i, x in grid:
        dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        mine = by[i, dev]
        assert mine
        for r in mine:
            want = float((x - sums / n) @ q[:, r.component - 1] / np.sqrt(e[r.component - 1]))
            if abs(want) > 1e-6:
                sign.setdefault(r.component, np.sign(want) * np.sign(r.whitened))
            assert abs(want * sign.get(r.component, 1) - r.whitened) < 1e-7


def test_whitening_of_real_vectors(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check_whitening(whitening.whitened(rows).collect(), [(r.vec_id, r.embedding) for r in rows.collect()])


def test_whitening_on_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(20) * np.arange(1, 21)).tolist()) for i in range(300)]
    rows += [(300, None), (301, []), (302, [None] * 20), (303, [float("nan")] * 20), (304, [float("inf")] * 20), (305, [1.0, 2.0]), (306, [3e38] * 20)]
    copies = [(i + 400, rows[7][1]) for i in range(200)] + [(None, rows[9][1]), (12, rows[12][1])]
    got = whitening.whitened(vectors(spark, rows + copies)).collect()
    check_whitening(got, [r for r in rows + copies if r[0] not in (300, 301, 302, 303, 304, 305, 306)])


def test_whitening_with_a_narrow_subspace(spark):
    """More dimensions than columns of the subspace: the filter has work to do."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(90) * (1 + np.arange(90) % 7)).tolist()) for i in range(800)]
    w = whitening.fit(whitening.fit_blocks(whitening.gridded(vectors(spark, rows))), components=4)
    assert len(w.values) == 4 and w.passes > 3
    check_whitening(whitening.whitened(vectors(spark, rows), components=4).collect(), rows, 4)


def test_filter_damps_below_the_cut():
    values = np.linspace(0, 10, 101)
    out = whitening.filtered(lambda q: values[:, None] * q, np.ones((101, 1)), 6.0, 10.0, 8)[:, 0]
    assert abs(out[-1] - 1) < 1e-9 and np.abs(out[:60]).max() < 0.01 and (np.diff(np.abs(out[61:])) > 0).all()


def test_whitening_without_variance(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whitened(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    flat = [(i, [float(i), 5.0, float(i)]) for i in range(9)]
    assert {r.component for r in whitening.whitened(vectors(spark, flat)).collect()} == {1}


def test_large_grid_values_stay_exact(spark):
    rows = [(i, [float(i * 1000), float(i % 3)]) for i in range(50)]
    check_whitening(whitening.whitened(vectors(spark, rows)).collect(), rows)
