"""Every operator against a plain version, on documents with NULLs, copies, empty and long texts, and clashing columns."""

import hashlib
import re
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from samples import TEXTS, contamination, crc, documents, jaccard, ordered, substrings  # noqa: E402

from bidlift.llm import (  # noqa: E402
    coder, decontaminate, jaccard as near, packing, quality, secrets, sentences, sharding, suffixes, tokenfile, urls,
)

SMALL = "/root/testdata/sf0.001"
ITEMS = [
    (1, "seven wizards quietly mix black potions under a pale moon the quick"), (2, "Plain WORDS"), (None, "and an end"),
    (3, None), (4, ""), (5, "not in any of the texts at all, ever"), (1, "seven wizards quietly mix black potions under a pale moon the quick"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def small(spark, name="documents"):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


# secrets


def test_trigram_queries_are_mandatory():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == []
    assert secrets.trigram_query(r"(abc|x)y") == []  # "xy" holds no trigram
    assert secrets.trigram_query(r"ab?cd") == [frozenset({"abc", "bcd"}), frozenset({"acd"})]
    assert secrets.trigram_query(r"abc\d+def") == [frozenset({"abc", "def"})]


def plain_spans(text, rule):
    return [
        (m.start(), m.end()) for m in re.finditer(rule.pattern, text or "") if len(m.group(2 if rule.group2 else 0)) >= rule.least
    ]


def test_secrets_equal_a_full_scan(docs):
    got = ordered(secrets.scan_secrets(docs).collect())
    want = []
    for id, text in TEXTS:
        spans = [[(a, k, f"{r.name}:{a}:{b}") for a, b in plain_spans(text, r)] for k, r in enumerate(secrets.RULES)]
        base = ",".join(s for _, _, s in sorted(sum(spans[:3], [])))
        want.append((id, *map(len, spans[:3]), hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, _, s in sorted(sum(spans, [])))))
    assert got == ordered(want)
    assert any(r[1] == 2 and r[2] == 1 and r[3] == 1 for r in got)


def test_short_match_uses_up_its_text(spark):
    texts = [(1, "token=token:abcdefg"), (2, "token=token=abcdefg"), (3, "😀 token=abcdef")]
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(documents(spark, texts)).collect()}
    assert got == {1: "", 2: "assign:0:19", 3: "assign:2:14"}


def test_redaction(docs, none, spark):
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    text = out.where("doc_id = 11").first().text
    assert text == "[SECRET] and [SECRET]' and token=ab secret=\"q\" [SECRET] [SECRET]"
    assert ordered(out.where("doc_id <> 11").select("doc_id", "text").collect()) == ordered(
        docs.where("doc_id <> 11").select("doc_id", "text").collect()
    )
    assert secrets.redact(none).count() == 0 and secrets.scan_secrets(none).count() == 0
    tokens = documents(spark, [(1, "ghp_" + "a1" * 18), (2, "-----BEGIN RSA PRIVATE KEY-----")])
    assert {r.doc_id: r.spans.split(":")[0] for r in secrets.scan_secrets(tokens).collect()}[2] == "pem"


# packing


def check_places(rows, width):
    """Every sequence is gapless and holds at most ``width`` ids."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= width
    return len(by)


def test_packing_places_every_piece(docs):
    rows = packing.pack_documents(docs).collect()
    enc = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for id, text in TEXTS:
        ids = enc.encode(text or "", add_special_tokens=False).ids + [2]
        start = 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 1024)):
            want.append((id, k, start, n, crc(ids[start : start + n])))
            start += n
        assert start == len(ids)
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == ordered(want)
    total = sum(r.length for r in rows)
    assert check_places(rows, 1024) <= -(-total // 1024) + 1


SPECIAL = [
    "a <|endoftext|> b", "<|endoftext|>", "in<|endoftext|>side, <|startoftext|>", "two  <|endoftext|>  three\n<|endoftext|>\tx", "<|endoftext|><|endoftext|> y",
    "<|startoftext|> <|ENDOFTEXT|> A<|startoftext|>B", "cut <|endof text|> <| endoftext|> <|endoftext|", "é<|endoftext|>漢 'll<|endoftext|>'ll <|endoftext|>'ll",
]


@pytest.mark.parametrize("name,lead", [("byte_bpe_50k.json", " "), ("word_bpe_49k.json", "")])
@pytest.mark.parametrize("plain", [False, True])
def test_special_strings_are_encoded_as_the_library_does(name, lead, plain):
    from bidlift.llm.tokens import WordEncoder

    texts = SPECIAL + [" ".join(SPECIAL)] + [t or "" for _, t in TEXTS]
    enc = Tokenizer.from_file(public_tokenizers.path(name))
    enc.encode_special_tokens = plain
    want = [enc.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sizes = WordEncoder(public_tokenizers.path(name), lead, plain).encode(texts)
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@pytest.mark.parametrize("name,lead", [("byte_bpe_50k.json", " "), ("word_bpe_49k.json", "")])
def test_words_are_told_apart_by_their_bytes(name, lead):
    """Signs that a normalizer changes, joins or drops, and text that looks like the sign of a word's end."""
    import random

    from bidlift.llm.tokens import WordEncoder

    rnd = random.Random(5)
    signs = ["a", "B", "é", "e\u0301", "\u0301", "İ", "ß", "ﬁ", "각", "가\u11a8", "😀", "1", "²", " ", "  ", "\n", "\u00a0", "\u200b", "'s", "</w>", "<", "|", ".", "\x02", "\u212b", "ẛ̣"]
    texts = ["".join(rnd.choices(signs, k=rnd.randrange(30))) for _ in range(5000)]
    enc = Tokenizer.from_file(public_tokenizers.path(name))
    want = [enc.encode(t, add_special_tokens=False).ids for t in texts]
    ids, sizes = WordEncoder(public_tokenizers.path(name), lead).encode(texts)
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_special_strings_in_packing_and_token_files(spark):
    docs = documents(spark, list(enumerate(SPECIAL)))
    for name, end, rows in (
        ("byte_bpe_50k.json", 2, packing.pack_documents(docs).withColumnRenamed("length", "n_tokens")),
        ("word_bpe_49k.json", 1, tokenfile.round_trip(docs)),
    ):
        enc = Tokenizer.from_file(public_tokenizers.path(name))
        want = [enc.encode(t, add_special_tokens=False).ids + [end] for t in SPECIAL]
        assert ordered(rows.select("doc_id", "n_tokens", "ids_crc32").collect()) == ordered((i, len(w), crc(w)) for i, w in enumerate(want))


def test_packing_is_near_the_bound(spark):
    rows = packing.pack_documents(small(spark)).collect()
    assert check_places(rows, 1024) <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_packing_of_nothing_and_with_ids(none, docs):
    assert packing.pack_documents(none).count() == 0
    r = packing.pack_documents(docs, with_ids=True).where("doc_id = 9").first()
    assert list(r.ids) == [64, 2] and r.ids_crc32 == crc([64, 2])


@pytest.mark.parametrize("count", [{1: 5}, {1024: 3, 512: 4}, {700: 10, 300: 4, 24: 9, 5: 100}, {n: n % 7 for n in range(1, 1025)}])
def test_plan_uses_every_piece_once(count):
    runs, sequences = packing.plan(count)
    used = Counter()
    for length, first, number, _, _ in sorted(runs):
        assert first == used[length]
        used[length] += number
    assert used == Counter({n: c for n, c in count.items() if c})
    total = sum(n * c for n, c in count.items())
    assert -(-total // 1024) <= sequences <= 1.25 * total / 1024 + 1


def test_plan_is_never_above_best_fit_alone():
    import numpy as np

    rng = np.random.default_rng(4)
    many = {
        "even": rng.integers(1, 1025, 30_000), "middle": rng.integers(300, 701, 20_000), "few": rng.choice([700, 450, 333, 310, 120], 9_000),
        "skewed": np.clip(rng.lognormal(5, 1, 30_000).astype(int), 1, 1024), "hot": np.append(rng.integers(1, 1025, 500), np.full(5_000, 341)),
    }
    for name, lengths in many.items():
        count = dict(Counter(lengths.tolist()))
        assert packing.plan(count)[1] <= packing.plan_with(count, 1024, 0)[1], name
    thirds = packing.plan({512: 10, 341: 20, 342: 10})
    assert thirds[1] == 15  # five pairs and ten triples


# suffixes


def test_substrings_equal_brute_force(docs):
    some = [(i, t) for i, t in TEXTS]
    got = suffixes.dedup_substrings(docs).drop("kept").collect()
    assert ordered(got) == ordered(substrings(some))


def test_substrings_of_real_documents(spark):
    d = small(spark).select("doc_id", "text")
    got = suffixes.dedup_substrings(d).drop("kept").collect()
    assert ordered(got) == ordered(substrings([tuple(r) for r in d.collect()]))


def test_substrings_of_runs_and_nothing(spark, none):
    texts = [(1, "a" * 300), (2, "a" * 49), (3, "b" + "a" * 60 + "b" + "a" * 20), (4, "ab" * 100), (5, "xx" + "ab" * 30)]
    d = documents(spark, texts)
    got = suffixes.dedup_substrings(d, with_kept=True).collect()
    assert ordered(r[:5] for r in got) == ordered(substrings(texts))
    assert bytes(next(r.kept for r in got if r.doc_id == 3)) == b"bb" + b"a" * 20
    assert suffixes.dedup_substrings(none).count() == 0


# sharding


def test_shards_are_even_and_keep_groups(docs, none, spark):
    rows = sharding.sharded(docs).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(TEXTS) and max(sizes.values()) <= 1
    for r in rows:
        text = next((t or "") for i, t in TEXTS if i == r.doc_id and crc_text(t) == r.text_crc32)
        assert r.size == len(text.encode()) + 8
    assert sharding.sharded(none).count() == 0
    texts = [(i, f"text {i // 3}") for i in range(240)] + [(1000 + i, "hot") for i in range(120)]
    rows = sharding.shard_documents(documents(spark, texts, clash=False), shards=6).collect()
    sizes, groups = Counter(r.shard for r in rows), {}
    for r in rows:
        groups.setdefault(r.group, set()).add(r.shard)
    assert set(sizes.values()) == {60}
    assert sum(len(g) == 1 for g in groups.values()) >= 60  # of 80 triples, without a free place
    assert min(len(g) for g in groups.values() if len(g) > 1) >= 2
    for j in range(6):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(60))


def test_a_text_larger_than_a_shard_fills_few_shards(spark):
    """8,000 copies of one text, 2,000 texts of four copies, 8,000 of one, ids in ties: 24 shards of 1,000 rows."""
    texts = [(i // 2, "hot") for i in range(8000)] + [(i, f"four {i // 4}") for i in range(8000)] + [(i, f"one {i}") for i in range(8000)]
    rows = sharding.shard_documents(documents(spark, texts, clash=False)).collect()
    assert len(rows) == 24000 and set(Counter(r.shard for r in rows).values()) == {1000}
    hot = Counter(r.shard for r in rows if r.text_crc32 == crc_text("hot"))
    assert sum(hot.values()) == 8000 and len(hot) <= 9, hot
    groups = {}
    for r in rows:
        groups.setdefault(r.group, []).append(r.shard)
    whole = sum(len(set(g)) == 1 for g in groups.values() if len(g) == 4)
    assert whole >= 1800, whole


def crc_text(text):
    import zlib

    return zlib.crc32((text or "").encode())


# decontamination


def test_contamination_equals_brute_force(docs, spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.judged(docs, items).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert ordered(got) == ordered(contamination(TEXTS, ITEMS))


def test_decontamination_of_texts(docs, none, spark):
    items = spark.createDataFrame([(1, "seven wizards quietly mix black potions under a pale moon the quick")], "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {2, 4, None, 5, 6, 8, 9, 10, 11, 12}
    cut = decontaminate.decontaminate(docs, items, action="spans")
    text = cut.where("doc_id = 7").first().text
    assert "wizards" not in text.split("moon. ")[0] and text.startswith("Another start here, then the same. the")
    assert decontaminate.decontaminate(none, items).count() == 0
    no_items = items.where("item_id > 1")
    assert decontaminate.decontaminate(docs, no_items).count() == len(TEXTS)
    assert decontaminate.judged(none, items).count() == 0


# token files


def test_coder_round_trip():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, block in [(1, 8), (8, 8), (9, 8), (1000, 64)]:
        for ids in (rng.integers(0, 49408, n), rng.zipf(1.4, n) % 49408, np.full(n, 49407)):
            # No prior, the ids' own, and one that misleads.
            for prior in (None, coder.make_prior(ids, 193), coder.make_prior(49407 - ids, 193)):
                coded = coder.encode_blocks(ids, block, 193, prior)
                counts = [min(block, n - i) for i in range(0, n, block)]
                assert (np.concatenate(coder.decode_blocks(coded, counts, 193, prior)) == ids).all()
                # Blocks stand alone.
                assert (coder.decode_blocks(coded[-1:], counts[-1:], 193, prior)[0] == ids[sum(counts[:-1]) :]).all()
    many = np.tile(rng.integers(0, 49408, 50), 60)
    assert sum(map(len, coder.encode_blocks(many, 3000, 193))) < 1.0 * len(many)


def test_coder_is_smaller_than_deflate(spark):
    """On real ids, prior included, against deflate of each block and of all ids at once."""
    import zlib

    import numpy as np

    enc = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r.text or "" for r in small(spark).select("text").collect()]
    ids = np.concatenate([np.array(e.ids + [1], np.int64) for e in enc.encode_batch(texts, add_special_tokens=False)])
    prior = coder.make_prior(ids, 193)
    size = len(prior) + sum(map(len, coder.encode_blocks(ids, tokenfile.BLOCK, 193, prior)))
    plain = ids.astype("<u2")
    assert size < 0.95 * len(zlib.compress(plain.tobytes(), 9))
    assert size < 0.8 * sum(len(zlib.compress(plain[i : i + tokenfile.BLOCK].tobytes(), 9)) for i in range(0, len(ids), tokenfile.BLOCK))


def test_token_file_round_trip(docs, none, spark):
    from bidlift.session import fresh_path

    enc = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = tokenfile.round_trip(docs).collect()
    want = {}
    for id, text in TEXTS:
        ids = enc.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault(id, []).append((len(ids), crc(ids)))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert tokenfile.round_trip(none).count() == 0
    path = fresh_path(spark, "tokens")
    tokenfile.write_token_file(docs, path, block=64, segment=500)
    again = tokenfile.read_token_file(spark, path, with_ids=True)
    assert list(again.where("doc_id = 9").first().ids) == enc.encode("a", add_special_tokens=False).ids + [1]


def test_damage_is_noticed(docs, spark):
    from pyspark.sql import functions as F

    from bidlift.session import fresh_path

    path, broken = fresh_path(spark, "tokens"), fresh_path(spark, "tokens")
    tokenfile.write_token_file(docs, path)
    spark.read.parquet(path).withColumn("checks", F.transform("checks", lambda c: c + 1)).write.parquet(broken)
    with pytest.raises(Exception, match="damaged"):
        tokenfile.read_token_file(spark, broken).collect()


# sentences


def test_sentence_spans(docs, none, spark):
    out = sentences.dedup_sentences(docs)
    assert out.columns == [*docs.columns, "_dedup"] and out.count() == len(TEXTS)
    passage = "One two three four five six seven eight nine ten. " + "Eleven is more than ten, twelve is more than eleven, and so on. " * 1 + "Then comes the end of the passage, which is long enough. "
    clean = "This text stands alone and shares nothing. It has two sentences of its own, and a third. Here it is."
    texts = [(1, "First. " + passage + "Last one."), (2, "Before it. " + passage + "After."), (3, clean), (4, "Hello. Yes."), (5, "Hello. Yes.")]
    got = {r.doc_id: r for r in sentences.deduped(documents(spark, texts, clash=False)).collect()}
    assert not got[1].changed and not got[3].changed and not got[4].changed and not got[5].changed
    assert got[2].text == "Before it. After." and got[2].n_removed == 3
    assert sentences.deduped(none).count() == 0


def test_runs_are_minimal():
    found = ["a " * 10, "b " * 10, "c " * 10, "d " * 45, "e"]
    assert list(sentences.runs(found, 2, 20)) == [(0, 1), (1, 2), (2, 3), (3, 3)]
    assert sentences.sentences("A b. C d!\nE f") == ["A b. ", "C d!\n", "E f"]
    assert "".join(sentences.sentences("x. y\n z?? q")) == "x. y\n z?? q"


def test_sentence_tails_go_too(spark):
    def passage(name, *sizes):
        return "".join(" ".join([f"{name}{k}x{i}" for i in range(n - 1)] + ["end. "]) for k, n in enumerate(sizes))

    texts = []
    for k, sizes in enumerate([(45, 38), (38, 45), (12, 12, 12, 12, 7), (45, 3), (10, 11, 1, 1)]):
        shared = passage(f"p{k}", *sizes)
        texts += [(10 * k, shared + f"Here it goes on {k}."), (10 * k + 1, f"Another start {k}. " + shared + f"Then it ends {k}."), (10 * k + 2, shared)]
    got = {r.doc_id: r for r in sentences.deduped(documents(spark, texts, clash=False)).collect()}
    for k in range(5):
        assert not got[10 * k].changed
        assert got[10 * k + 1].text == f"Another start {k}. Then it ends {k}."
        assert got[10 * k + 2].text == ""


def test_covering_runs_equal_all_runs():
    import random

    rng = random.Random(7)
    for _ in range(300):
        found = ["w " * rng.choice([1, 3, 7, 12, 19, 20, 38, 39, 40, 45]) for _ in range(rng.randint(0, 9))]
        size = [len(s.split()) for s in found]
        short = sentences.covering(found, 2, 20)
        for a in range(len(found)):
            for b in range(a + 1, len(found)):
                if sum(size[a : b + 1]) >= 20:
                    inside = {k for x, y in short if a <= x and y <= b for k in range(x, y + 1)}
                    assert inside == set(range(a, b + 1))


# quality


def test_counts_of_a_text():
    text = "a b c a b c\nx\nx\n\n| # "
    assert quality.count_text(text) == (10, 10, 2, 1, 6, 4)
    assert quality.count_text("") == (0, 0, 0, 0, 0, 0)
    assert quality.count_text("ä\x0bß\x1cq") == (2, 4, 0, 0, 0, 1)  # 1C is a word character


def test_quality_keeps_clean_and_drops_junk(spark):
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9)))
    texts = [(i, " ".join(word() for _ in range(120))) for i in range(60)]
    texts += [(100, "spam " * 300), (101, " | ".join(word() for _ in range(90))), (102, "too short"), (103, None)]
    got = {r.doc_id: r for r in quality.score_documents(documents(spark, texts, clash=False)).collect()}
    assert all(got[i].kept for i in range(60))
    assert not any(got[i].kept for i in (100, 101, 102, 103))
    assert got[102].base_failed and not got[101].base_failed


def test_thresholds_follow_each_source(spark):
    """Every measure's threshold is its own source's: what is usual in one fails in the other."""
    import random

    rng = random.Random(5)
    # Documents, symbols, repeated lines, repeated words, letters a word.
    sources = {"plain": (450, 0, 0, 0, 5), "noisy": (150, 60, 300, 200, 9)}
    texts, at = [], 0

    def document(symbols, dups, repeats, letters):
        word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(letters + rng.randint(-1, 1)))
        lines = [" ".join(word() for _ in range(4)) for _ in range(100)]
        for i in rng.sample(range(50, 100), dups * rng.randint(50, 100) // 1000):
            lines[i] = lines[i - 50][:7]
            lines[i - 50] = lines[i]
        said = [word() for _ in range(3)]
        lines += [" ".join(said) + " " + word() for _ in range(repeats * rng.randint(50, 100) // 500)]
        return "\n".join(lines) + " " + " ".join("#" * (symbols * rng.randint(50, 100) // 100) for _ in range(2))

    for source, kind in sources.items():
        for _ in range(kind[0]):
            texts.append((at, document(*kind[1:]), "en", source))
            at += 1
    strangers = [(1000, document(60, 0, 0, 5)), (1001, document(0, 0, 0, 9)), (1002, document(0, 0, 200, 5)), (1003, document(0, 300, 0, 5))]
    texts += [(i, t, "en", "plain") for i, t in strangers]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")
    # A small weight of the language: these groups are too few and small to outweigh 20 documents of it at the 98 % level.
    limits = {r.source: r for r in quality.thresholds(quality.sketches(quality.with_counts(rows, "counts")), prior=2).collect()}
    for name, (_, both) in quality.MEASURES.items():
        assert limits["noisy"][f"high_{name}"] > limits["plain"][f"high_{name}"], name
        assert not both or limits["noisy"][f"low_{name}"] > limits["plain"][f"low_{name}"], name
    got = {r.doc_id: r.kept for r in quality.score_documents(rows).collect()}
    assert not any(got[i] for i in range(1000, 1004)), got
    assert sum(got[i] for i in range(600)) >= 588


def test_quality_on_awkward_documents(docs, none):
    rows = quality.score_documents(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.kept is not None for r in rows)
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert quality.score_documents(none).count() == 0 and quality.filter_documents(none).count() == 0


def test_sketches_merge(docs):
    from pyspark.sql import functions as F

    counted = quality.with_counts(docs, "counts")
    whole = {tuple(r)[:4]: r.n for r in quality.sketches(counted).collect()}
    parts = quality.sketches(counted.where("doc_id < 6")).union(quality.sketches(counted.where("doc_id >= 6 or doc_id is null")))
    merged = parts.groupBy("lang", "source", "measure", "value").agg(F.sum("n").alias("n"))
    assert {tuple(r)[:4]: r.n for r in merged.collect()} == whole


# urls

PAGES = [
    (1, "https://a.Example.ORG/es/1?x=1"), (2, "http://example.org/en/12"), (3, "http://notexample.org/en/1"), (4, "ftp://x.com/fr/#a://b"),
    (5, "http://x.com/de/"), (6, "no scheme"), (7, None), (8, "http://x.com"), (9, "://org/"), (10, "http://org/"), (None, "http://x.com?q"), (1, "http://x.net/de/"),
]


def test_url_base_rules(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = ordered((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, labels).collect())
    want = [
        (1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "notexample.org", "/en/1", "org/", "allow"), (4, "x.com", "/fr/", "com/fr/", "allow"), (5, "x.com", "/de/", "com/de/", "block"),
        (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "x.com", "", None, "allow"), (9, "org", "/", "org/", "allow"),
        (10, "org", "/", "org/", "allow"), (None, "x.com", "", None, "allow"), (1, "x.net", "/de/", None, "allow"),
    ]
    assert got == ordered(want)
    assert urls.judge_urls(pages.where("page_id > 99"), labels).count() == 0


def test_url_rules_are_mined_and_matched(spark):
    rows = [(i, f"http://{'bad' if i % 4 == 0 else 'good'}.net/p/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, None) for i in range(0, 300)], "doc_id bigint, quality int, toxic int")
    rules = urls.mine_rules(pages, labels).collect()
    known = [(set(urls_tokens(u)), i % 4 == 0) for i, u in rows[:300]]
    for r in rules:
        met = [bad for tokens, bad in known if set(r.tokens) <= tokens]
        assert len(met) >= urls.LEAST_PAGES and sum(met) / len(met) == pytest.approx(r.confidence) and r.confidence >= urls.CONFIDENCE
    got = {r.page_id: r for r in urls.judge_urls(pages, labels).collect()}
    for i, u in rows:
        want = sum(set(r.tokens) <= set(urls_tokens(u)) for r in rules)
        assert got[i].n_mined == want and got[i].verdict == ("block" if want else "allow")
    assert got[396].verdict == "block" and got[397].verdict == "allow"


def all_rules(baskets, least, confidence):
    """Every set of tokens that enough baskets hold and that says bad often enough, counted one by one."""
    from itertools import combinations

    held, bad = Counter(), Counter()
    for tokens, is_bad in baskets:
        for k in range(1, len(tokens) + 1):
            for subset in combinations(sorted(tokens), k):
                held[subset] += 1
                bad[subset] += is_bad
    return {s: bad[s] / n for s, n in held.items() if bad[s] >= least and bad[s] >= confidence * n}


def test_mined_rules_are_all_rules(spark):
    """No rule is missed or invented: made-up pages with ties, and the given pages at parameters at which rules appear."""
    rows = [(i, f"http://{'ab'[i % 2]}{i % 3}.net/p{'q' * (i % 5 == 0)}/x") for i in range(90)] + [(1000, None), (1001, "no scheme")]
    made = spark.createDataFrame(rows, "page_id bigint, url string")
    marks = spark.createDataFrame([(i, int(i % 6 not in (0, 3)), None) for i in range(92)], "doc_id bigint, quality int, toxic int")
    cases = [(made, marks, 4, 0.6), (small(spark, "pages"), small(spark, "labels"), 2, 0.3)]
    for pages, labels, least, confidence in cases:
        known = pages.join(labels, pages.page_id == labels.doc_id).select(
            "page_id", urls.url_tokens(pages.url).alias("t"), ((labels.quality == 0) | (labels.toxic == 1)).alias("bad")
        ).where("size(t) > 0").collect()
        worst = {}
        for r in known:
            worst.setdefault(r.page_id, [set(r.t), False])[1] |= bool(r.bad)
        want = all_rules([(t, b) for t, b in worst.values()], least, confidence)
        got = {tuple(r.tokens): r.confidence for r in urls.mine_rules(pages, labels, 0.0, confidence, least).collect()}
        assert set(got) == set(want) and all(got[k] == pytest.approx(v) for k, v in want.items())
        assert got


def urls_tokens(url):
    host = url.split("://")[1].split("/")[0]
    return [f"host={host}", "host=net", f"sub={host.split('.')[0]}", "path=p", "path=0", "ending=", "scheme=http"]


# Jaccard join


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 50)])
def test_join_equals_brute_force(docs, words, percent):
    rows = near.link_documents(docs, words, percent).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    want = jaccard(TEXTS, words, percent)
    alone = [(i, n, i if n == 0 else c, k) for i, n, c, k in want]
    assert ordered(rows) == ordered(alone)


def test_join_over_many_groups_and_blocks(spark, monkeypatch):
    import random

    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(120)] = f"e{i}-{rng.randrange(9)}"
        texts.append((i, " ".join(w)))
    monkeypatch.setattr(near, "MEMBERS", 7)
    monkeypatch.setattr(near, "QUERIES", 5)
    rows = near.link_documents(documents(spark, texts, clash=False)).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert ordered(rows) == ordered(jaccard(texts, 3, 90))


def test_keep_one_of_each_group(docs, none):
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 6 is near 5, 7 copies 1, the NULL id copies 3; texts without words stay, one an id.
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 8, 9, 10, 11, 12] and ids.count(None) == 1
    assert near.keep_one(none).count() == 0 and near.link_documents(none).count() == 0
