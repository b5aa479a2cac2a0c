"""Manifest, ranked search and n-gram join: odd and empty tables, and plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tidemark.llm import language, lm, manifest, ngram_join, search, sharding

from .conftest import PROSE, sentence

FIVE = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


# manifest


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def plain_climb(levels, place, held):
    proof = []
    for level in levels[:-1]:
        base = place // 3 * 3
        run, at = level[base : base + 3], place - base
        proof += run[:at] + run[at + 1 :]
        held = digest("".join([*run[:at], held, *run[at + 1 :]]))
        place //= 3
    return proof, held


def plain_manifest(docs):
    """Rows of the manifest by sorting, in lists."""
    sources = defaultdict(list)
    for r in docs.select(*FIVE).collect():
        leaf = held = digest("".join(field(r[c]) for c in FIVE))
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
            held = digest("".join(field(r[c]) for c in FIVE[:-1]) + field(r["text"].replace("\n", "")))
        sources[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, held, r["doc_id"]))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    top, found = plain_levels([trees[s][-1][0] for s in names]), []
    for k, s in enumerate(names):
        for place, (_, _, leaf, held, doc_id) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            lower, held = plain_climb(trees[s], place, held)
            upper, held = plain_climb(top, k, held)
            root = top[-1][0]
            found.append((doc_id, leaf, trees[s][-1][0], root, digest("".join(lower + upper)), held, held == root))
    return found


def test_manifest_of_odd_documents(odd_docs, no_docs):
    assert Counter(map(tuple, manifest.manifest(odd_docs).collect())) == Counter(plain_manifest(odd_docs))
    assert manifest.manifest(no_docs).count() == 0


@pytest.mark.parametrize("low", [1, 6])
def test_manifest_of_many_sources_and_equal_rows(make_docs, monkeypatch, low):
    monkeypatch.setattr(manifest, "LOW", low)
    rows = [(i, f"line {i}\nnext", "en", "hot" if i % 2 else f"s{i % 23}") for i in range(150)]
    rows += [(None, "copy", "en", "hot")] * 40 + [(7, "a\nb", "en", "hot")] * 3
    docs = make_docs(rows)
    found = manifest.manifest(docs).collect()
    assert Counter(map(tuple, found)) == Counter(plain_manifest(docs))
    assert {r["verified"] for r in found} == {True, False}


def test_manifest_of_one_row_and_one_source(make_docs):
    for rows in ([(1, "x", "en", "a")], [(i, "x\n", "en", None) for i in range(10)]):
        docs = make_docs(rows)
        assert Counter(map(tuple, manifest.manifest(docs).collect())) == Counter(plain_manifest(docs))


# search


def plain_search(docs, items, top=10):
    def terms(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())

    held = [(r["doc_id"], Counter(terms(r["text"]))) for r in docs.select("doc_id", "text").collect()]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for r in items.select("item_id", "text").collect():
        scores = []
        for i, c in held:
            m, score = 10 + 90 * sum(c.values()) * n // length, 0
            for t in set(terms(r["text"])) & c.keys():
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:top], 1):
            found.append((r["item_id"], rank, i, -score))
    return found


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the mill by the river"), (2, None), (3, " .. !"), (None, "日本語 again flour"), (5, PROSE.upper()), (5, "short text")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as score", "2 as rank", "3 as item")


def test_search_of_odd_documents(odd_docs, no_docs, items):
    found = Counter(map(tuple, search.search(odd_docs, items).collect()))
    assert found == Counter(plain_search(odd_docs, items)) and found
    assert search.search(no_docs, items).count() == 0
    assert search.search(odd_docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("block", [40, 1 << 22])
def test_search_like_scoring_all(make_docs, items, spark, monkeypatch, block):
    """Frequent and rare terms, ties, repeated documents, several blocks of items."""
    monkeypatch.setattr(search, "BLOCK_CHARS", block)
    rng = random.Random(5)
    words = [f"t{i}" for i in range(60)]
    rows = [(i // 2 if i % 9 == 0 else i, " ".join(words[min(59, int(rng.expovariate(0.12)))] for _ in range(rng.randint(1, 30))), "en", "s") for i in range(900)]
    docs = make_docs(rows)
    asked = [(i, " ".join(rng.sample(words, rng.randint(1, 12)))) for i in range(25)]
    asked = spark.createDataFrame(asked, "item_id long, text string")
    assert Counter(map(tuple, search.search(docs, asked).collect())) == Counter(plain_search(docs, asked))


def test_segments_skip_without_losing_any():
    """Many ranges and small segments give what one sum over all postings gives."""
    rng = np.random.default_rng(3)
    columns, n = [], 5000
    weights = rng.integers(1, 9000, 30)
    for _ in range(n):
        terms = np.unique(np.minimum(rng.geometric(0.15, 8) - 1, 29))
        columns.append(([int(rng.integers(0, 10**6))], [int(rng.integers(5, 90))], np.array([len(terms)]), terms, rng.integers(1, 4, len(terms))))
    whole = search.Segment(columns, weights, n, n * 40)
    for _ in range(20):
        terms, best, every = np.unique(rng.integers(0, 30, 6)), search.Best(), np.zeros(n, np.int64)
        for part in range(0, n, 1700):
            search.Segment(columns[part : part + 1700], weights, n, n * 40).search(terms, best)
        for t in terms:
            docs, gain = whole.list_of(t)
            np.add.at(every, docs, gain)
        expected = sorted(zip(-every, whole.ids))[: search.TOP]
        assert list(zip(-best.score, best.id)) == expected


# n-gram join


def plain_ngrams(docs, width=4, percent=85):
    sets, ids = [], []
    for r in docs.select("doc_id", "text").collect():
        words = (r["text"] or "").encode().lower().split()
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)}
        sets.append(frozenset(grams if words else ()))
        ids.append(r["doc_id"])
    above = list(range(len(sets)))

    def root(k):
        while above[k] != k:
            k = above[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large and root(a) != root(b):
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (small + large - common):
                    above[root(a)] = root(b)
    least = defaultdict(list)
    for k, i in enumerate(ids):
        least[root(k)].append(i)
    return [
        (i, len(s), min((x for x in least[root(k)] if x is not None), default=None) if s else i)
        for k, (i, s) in enumerate(zip(ids, sets))
    ]


def test_ngram_join_of_odd_documents(odd_docs, no_docs):
    found = Counter(map(tuple, ngram_join.ngram_components(odd_docs).collect()))
    assert found == Counter(plain_ngrams(odd_docs))
    assert ngram_join.ngram_components(no_docs).count() == 0


@pytest.mark.parametrize("members, percent", [(512, 85), (8, 85), (8, 70)])
def test_ngram_join_like_all_pairs(make_docs, monkeypatch, members, percent):
    """Families of near copies, a chain, pages on one template, copies and a passage in many documents."""
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    monkeypatch.setattr(ngram_join, "QUERIES", members)
    rng, texts = random.Random(members + percent), []
    base = [f"b{i}" for i in range(120)]
    for n in range(60):  # near copies of one text: one to three words changed
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(120)] = f"c{rng.randrange(10**6)}"
        texts.append(words)
    chain = [f"d{i}" for i in range(100)]
    for n in range(40):  # each differs from the one before in one word
        chain = list(chain)
        chain[(n * 37) % 100] = f"e{n}"
        texts.append(chain)
    for n in range(40):  # one template, a third of the words their own
        texts.append([f"f{i}" if i % 12 > 3 else f"g{n}x{i}" for i in range(90)])
    passage = [f"p{i}" for i in range(50)]
    texts += [[*passage, *[f"q{n}x{i}" for i in range(rng.randint(0, 9))]] for n in range(40)]
    texts += [base] * 20 + [[f"short{rng.randrange(4)}"] * rng.randint(1, 9) for _ in range(30)]
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = make_docs(rows)
    found = ngram_join.ngram_components(docs, percent=percent).collect()
    assert Counter(map(tuple, found)) == Counter(plain_ngrams(docs, percent=percent))


def test_group_opens_only_for_enough_of_its_union():
    one, two = (np.arange(a, a + 20, dtype=np.uint64) for a in (0, 10))
    group = ngram_join.Group([one, two])
    assert group.linked(np.arange(1, 21, dtype=np.uint64), 85).tolist() == [0]
    assert group.linked(np.arange(5, 25, dtype=np.uint64), 85).tolist() == []
    assert group.linked(np.arange(50, 70, dtype=np.uint64), 85).tolist() == []


def test_long_text_is_read_whole(make_docs):
    text = sentence(3, 20_000)
    docs = make_docs([(1, text, "en", "a"), (2, text + " tail", "en", "a")])
    rows = {r["doc_id"]: r for r in ngram_join.ngram_components(docs).collect()}
    assert rows[2]["n_shingles"] == rows[1]["n_shingles"] + 1 and rows[2]["component_id"] == 1


# sharding


def check_shards(found, docs, shards, ranges):
    """The law and the columns, from plain Python; gives bytes of each shard."""
    plain = Counter()
    for r in docs.select("doc_id", "text").collect():
        text = (r["text"] or "").encode()
        plain[r["doc_id"], len(text) + 16, zlib.crc32(text)] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == plain
    sizes, slots = Counter({k: 0 for k in range(shards)}), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, longest = sum(sizes.values()), max(r["size"] for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= longest + 2 * (2 * total / (shards * ranges) + longest)
    return sizes


@pytest.mark.parametrize("kind", ["equal rows", "one text", "no ids", "mixed"])
def test_shards_keep_their_law_whatever_repeats(make_docs, kind):
    rng = random.Random(1)
    rows = {
        "equal rows": [(1, "the same row", "en", "a")] * 2_000,
        "one text": [(i, "the same text of all", "en", "a") for i in range(2_000)],
        "no ids": [(None, "the same text" if i % 2 else f"text {i}", "en", "a") for i in range(2_000)],
        "mixed": [(i % 40, None if i % 7 == 0 else "hot" if i % 3 == 0 else f"w{i} " * rng.randint(1, 40), "en", "a") for i in range(2_000)],
    }[kind]
    docs = make_docs(rows)
    found = sharding.shard(docs, shards=10, ranges=16).collect()
    check_shards(found, docs, 10, 16)
    assert sorted(map(str, found)) == sorted(map(str, sharding.shard(docs, shards=10, ranges=16).collect()))


def test_equal_texts_share_a_shard_in_a_cut_range(make_docs):
    """Ranges cut for their rows: only a text that is too much for a piece lies in several shards."""
    rows = [(i, "hot" if i < 800 else f"text {i % 300}", "en", "a") for i in range(2_000)]
    docs = make_docs(rows)
    found = sharding.shard(docs, shards=5, ranges=4, range_rows=60).collect()
    shards_of = defaultdict(set)
    for r in found:
        shards_of[r["text_crc32"]].add(r["shard"])
    assert [crc for crc, s in shards_of.items() if len(s) > 1] == [zlib.crc32(b"hot")]


# language model


def test_blocks_and_parts_do_not_change_scores(spark, odd_docs):
    """Blocks of a few texts and many parts of histories give what one block and one part give."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    docs = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    one, many = (
        sorted(map(tuple, lm.whole_scores(docs.repartition(n, "doc_id"), lm.held_out(), **sizes).collect()), key=repr)
        for n, sizes in ((1, {"frequent_words": 0}), (7, {"block": 500, "part": 20_000, "frequent_words": 9}))
    )
    assert [r[:5] for r in one] == [r[:5] for r in many]
    assert [x for r in one for x in r[5:]] == pytest.approx([x for r in many for x in r[5:]], rel=1e-9)


def test_arcs_of_more_histories_than_a_code_holds():
    history, marks = np.array([1 << 30, 5, 1 << 30, 5, 5]), np.array([7, 7, 7, 8, 7], np.uint64)
    found, which = lm._same(history, marks)
    assert found.tolist() == [5, 5, 1 << 30] and which.tolist() == [2, 0, 2, 1, 0]
    found, which = lm._same(np.minimum(history, 6), marks)
    assert found.tolist() == [5, 5, 6] and which.tolist() == [2, 0, 2, 1, 0]


def test_block_answers_are_packed_without_loss():
    arrays = [np.array(a, np.uint64) for a in ([], [0], [0, 0, 0], [1, 255, 256, 2**40 - 1], [2**63, 3])]
    back = lm._unpacked(lm._packed(arrays))
    assert [a.tolist() for a in back] == [a.tolist() for a in arrays]


@pytest.mark.parametrize("frequent", [0, 1, 5000])
def test_hot_history_in_every_block(spark, frequent):
    """One word that stands before every other keeps its count and its followers over all blocks."""
    rows = [(i, " ".join(f"the w{i * 7 + k}" for k in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    found = lm.whole_scores(docs, F.lit(False), block=100, part=500, frequent_words=frequent).collect()
    found = {r["doc_id"]: r for r in found}
    tokens = [[*t.split(), "\n"] for _, t in rows]
    ones = Counter(x for t in tokens for x in t)
    twos = Counter(g for t in tokens for g in zip(t, t[1:]))
    threes = Counter(g for t in tokens for g in zip(t, t[1:], t[2:]))
    after = Counter(g[:-1] for g in [*twos, *threes])
    whole = Counter()
    for g, n in [*twos.items(), *threes.items()]:
        whole[g[:-1]] += n
    size = sum(ones.values())

    def chance(history, word):
        if not history:
            return (ones[word] + 1) / (size + len(ones) + 1)
        own = (twos if len(history) == 1 else threes)[(*history, word)] - lm.DISCOUNT
        return (own + lm.DISCOUNT * after[history] * chance(history[1:], word)) / whole[history]

    for (i, _), t in zip(rows, tokens):
        score = sum(math.log10(chance(tuple(t[max(0, k - 2) : k]), x)) for k, x in enumerate(t))
        assert found[i]["score"] == pytest.approx(score, rel=1e-9)
        assert found[i]["train_tokens"] == size


# language


def plain_cost(sample, text):
    """Bits of a text by longest matches found in the sample itself, word by word."""
    found = 0
    for word in text.split():
        rest = language.OTHER.sub(" ", f" {word.lower()} ")
        while rest.strip(" ") and rest:
            n = 1
            while n < len(rest) and rest[: n + 1] in sample:
                n += 1
            found, rest = found + 1, rest[n:]
        found += rest == " "
    return found * math.log2(max(language.LEAST_CHARS, len(sample)))


def test_predictions_like_plain_parsing(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    samples = {k: v[:1500] for k, v in language.learn(docs.filter(~language.held_out())).items()}
    rows = docs.filter(language.held_out()).withColumn("told", language.predicted(spark, samples)).collect()
    assert len(samples) > 2 and len(rows) > 10
    for r in rows:
        if r["text"] and language.LETTER.search(r["text"]):
            cost = {k: plain_cost(v, r["text"]) for k, v in samples.items()}
            assert r["told"]["lang"] == min(cost, key=lambda k: (round(cost[k], 6), k))
            share = 1 / sum(2 ** max(-1000, min(cost.values()) - c) for c in cost.values())
            assert r["told"]["score"] == pytest.approx(share, rel=1e-6)


def script(label, rng, n):
    """Words in letters of the label's own."""
    return " ".join("".join(chr(0x4E00 + 12 * label + rng.randrange(12)) for _ in range(4)) for _ in range(n))


def test_every_one_of_many_labels_is_learned(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(script(k, rng, 120), f"l{k:03}") for k in range(300) for _ in range(4)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(language, "TOTAL_CHARS", 300 * 1100)
    samples = language.learn(labelled)
    assert len(samples) == 300 and sum(map(len, samples.values())) <= 300 * 1100
    asked = spark.createDataFrame([(script(k, rng, 30), f"l{k:03}") for k in range(300)], "text string, lang string")
    told = asked.withColumn("told", language.predicted(spark, samples))
    assert told.filter("told.lang = lang").count() == 300


def test_texts_of_a_clean_label_with_many_letters_stay(spark):
    """Text that no few letters make up costs many bits a character, in its own language too."""
    rng = random.Random(6)

    def odd(n):
        return " ".join("".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(3)) for _ in range(n))

    prose = [(i, sentence(i, 60), "en") for i in range(500)]
    rows = [*prose, *((1000 + i, odd(100), "zz") for i in range(600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language.accepted(docs, docs).collect()}
    assert sum(i >= 1000 for i in kept) >= 0.95 * 600 and sum(i < 1000 for i in kept) >= 0.95 * 500
    noise = docs.limit(0).union(spark.createDataFrame([(1, " ".join(map(chr, range(0x400, 0x4F0))), "en")], docs.schema))
    assert language.accepted(noise, docs.filter("lang = 'en'")).count() == 0
