"""Odd and empty tables, and every operator against a plain version on small ones."""

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

from tidemark.llm import decontamination, language, lm, mixing, near_dup, quality_rules, sharding, substring, url_filter
from tidemark.llm import token_files

from .conftest import PROSE, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def lowered(text):
    return text.encode().lower().split()


# mixing


def test_mix_of_odd_documents(odd_docs):
    rows = mixing.mix(odd_docs, ["doc_id"]).collect()
    assert len(rows) == 14
    per_source, longest = defaultdict(lambda: [0, 0.0, 0]), defaultdict(int)
    for r in rows:
        key = r["source_size"]
        per_source[key][0] += r["size"] * r["copies"]
        per_source[key][1] = r["target"]
        longest[key] = max(longest[key], r["size"])
        assert 0 <= r["copies"] <= 3
    for key, (taken, target, _) in per_source.items():
        assert abs(taken - target) <= longest[key] + 1
        assert target <= 3 * key
    total = sum(r["size"] for r in rows)
    assert sum(t for _, t, _ in per_source.values()) == pytest.approx(total)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs, ["doc_id"]).collect()))


def test_mixed_rows_keep_their_columns(odd_docs, no_docs):
    mixed = mixing.mixed_rows(odd_docs)
    assert mixed.dtypes == odd_docs.dtypes
    copies = {(r["row"]["doc_id"], r["row"]["text"]): 0 for r in mixing.mix(odd_docs, ["doc_id", "text"]).collect()}
    for r in mixing.mix(odd_docs, ["doc_id", "text"]).collect():
        copies[r["row"]["doc_id"], r["row"]["text"]] += r["copies"]
    found = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert found == Counter({k: n for k, n in copies.items() if n})
    assert mixing.mixed_rows(no_docs).count() == 0


def test_targets_stop_and_share_the_rest(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 400), ("c", 100), (None, 500)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5: a stops at 30, the other 980 are shared 2 : 1 : 5.
    assert found == pytest.approx({"a": 30.0, "b": 245.0, "c": 122.5, None: 612.5})


# substring


def plain_repeats(texts, window):
    lists = [WORD.findall(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def repeat_rows(seed):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(6 if seed % 2 else 300)]
    pool = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rng.choice(pool) if rng.random() < 0.4 else [rng.choice(words) for _ in range(rng.randint(1, 40))] for _ in range(4)]
        rows.append((i, " ".join(w for p in parts for w in p), "en", "s"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("most", [2_000, 1])
def test_substring_dedup_like_a_count_of_all_windows(make_docs, monkeypatch, seed, most):
    monkeypatch.setattr(substring, "MOST_KINDS", most)
    rows = repeat_rows(seed)
    found = {r["doc_id"]: tuple(r)[1:] for r in substring.remove_repeats(make_docs(rows), 12).collect()}
    assert found == dict(enumerate(plain_repeats([t for _, t, _, _ in rows], 12)))


def test_substring_dedup_of_odd_documents(odd_docs, no_docs):
    found = sorted(tuple(r)[1:] for r in substring.remove_repeats(odd_docs).collect())
    assert found == sorted(plain_repeats([t for _, t in texts_of(odd_docs)], 35))
    assert substring.remove_repeats(no_docs).count() == 0


def test_automaton_counts_substrings():
    rng = random.Random(4)
    kinds = [([bytes([97 + rng.randrange(3)]) for _ in range(rng.randint(4, 30))], rng.randint(1, 2)) for _ in range(8)]
    seen = Counter()
    for words, copies in kinds:
        for i in range(len(words) - 3):
            seen[tuple(words[i : i + 4])] += copies
    expected = [sum(1 << i for i in range(len(w) - 3) if seen[tuple(w[i : i + 4])] > 1) for w, _ in kinds]
    assert substring.repeated_windows(kinds, 4) == expected


# urls


def pages_of(spark, urls):
    rows = [(i, u, "size", "x") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, key string")


def test_url_rules_and_cascade(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Sub.Bad.COM/x?y#z", "http://bad.com", "http://notbad.com/",
            "https://a.net/x", "https://a.net", "https://b.example.net/en/1", "http://u.org/fr/2", "http://u.org/de/2",
            "http://example.com/de/", "ftp://É.bad.com/ü#f", "http://ok.com/://bad.com/"]
    listed = spark.createDataFrame([("bad.com",), ("bad.com",), (None,), ("elsewhere.test",)], "key string")
    many = pages_of(spark, urls + [f"http://h{i}.com/" for i in range(3000)] + [f"http://h{i}.bad.com/" for i in range(500)])
    for most in (50_000_000, 0):
        found = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge_pages(many, listed, most_listed=most).collect()}
        assert found[0] == found[2] == ("", "", None, "allow")
        assert found[4] == ("sub.bad.com", "/x", None, "block")
        assert found[5] == ("bad.com", "", None, "block") and found[6][3] == "allow"
        assert found[7] == ("a.net", "/x", "net/", "block") and found[8][2] is None
        assert found[9][2:] == ("example.net/en/", "allow") and found[10][2:] == ("org/fr/", "allow")
        assert found[11][2:] == (None, "allow") and found[12][2:] == ("example.com/de/", "block")
        assert found[13][0] == "É.bad.com" and found[13][3] == "block"
        assert found[14] == ("ok.com", "/://bad.com/", None, "allow")
        assert Counter(v[3] for v in found.values())["block"] == 505
    empty = spark.createDataFrame([], "key string")
    assert {r["verdict"] for r in url_filter.judge_pages(pages_of(spark, ["http://bad.com/"]), empty).collect()} == {"allow"}
    assert url_filter.judge_pages(many.limit(0), listed).count() == 0


# token files


@pytest.mark.parametrize("bits", [False, True])
def test_planes_hold_ids(bits):
    ids = np.random.default_rng(1).integers(0, 50_257, 777).astype("<u4")
    assert (token_files.from_planes(token_files.to_planes(ids, bits), 777) == ids).all()


def test_crc_of_pieces():
    data = bytes(range(256)) * 5
    cuts = [0, 1, 17, 17, 900, len(data)]
    assert token_files.crc_joined([(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]) == zlib.crc32(data)


def test_encoder_gives_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    path, rng = token_files.tokenizer_path(), random.Random(3)
    plain, encoder = Tokenizer.from_file(path), token_files.Encoder(path)
    signs = [*"ab 'sté\n\t\r1.,!  \x1c\x85  中½", "<|endoftext|>", " the", " a", " b.", "\n", "word", "ʰ", "ा"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    expected = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == expected


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_round_trip(odd_docs, no_docs, tmp_path, spark, bits):
    from tokenizers import Tokenizer

    folder = str(tmp_path / "tokens")
    token_files.write_tokens(odd_docs, folder, token_files.tokenizer_path(), bits, block=1000)
    plain = Tokenizer.from_file(token_files.tokenizer_path())
    found = token_files.read_index(spark, folder).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == [None, None, *sorted(i for i in ids if i is not None)]
    expected = Counter()
    for doc, text in texts_of(odd_docs):
        coded = [*plain.encode(text, add_special_tokens=False).ids, 0]
        expected[doc, len(coded), zlib.crc32(np.array(coded, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == expected
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
    assert token_files.written_and_read(no_docs, token_files.tokenizer_path()).count() == 0


# language model


def plain_scores(docs, kept):
    """Counts of all n-grams, and the recursion of the interpolated model."""
    tokens = {i: [*lowered(t), None] for i, t in docs}
    trained = {i: w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = [None] + [Counter(tuple(w[i : i + n]) for w in trained.values() for i in range(len(w) - n + 1)) for n in (1, 2, 3)]
    size, distinct = sum(counts[1].values()), len(counts[1])

    def most(grams):
        total, floor = 0, None
        for n, many in sorted(Counter(grams.values()).items(), reverse=True):
            total += many
            floor = n if total <= kept else floor
        return {g: n for g, n in grams.items() if floor and n >= floor}

    held = [{(): 0}, most(counts[1])]
    for n in (2, 3):
        held.append(most({g: c for g, c in counts[n].items() if c > 1 and g[:-1] in held[-1] and g[1:] in held[-1]}))
    rest = Counter()
    for n in (2, 3):
        for g, c in held[n].items():
            rest[g[:-1]] += (c - lm.DISCOUNT) / counts[n - 1][g[:-1]]

    def chance(history, word):
        if not history:
            return (counts[1][(word,)] + 1) / (size + distinct + 1)
        if history not in held[len(history)]:
            return chance(history[1:], word)
        gram = (*history, word)
        own = (held[len(gram)][gram] - lm.DISCOUNT) / counts[len(history)][history] if gram in held[len(gram)] else 0
        return own + (1 - rest[history]) * chance(history[1:], word)

    out = {}
    for i, w in tokens.items():
        base = sum(math.log10((counts[1][(x,)] + 1) / (size + distinct + 1)) for x in w)
        full = sum(math.log10(chance(tuple(w[max(0, k - 2) : k]), x)) for k, x in enumerate(w))
        out[i] = (i not in trained, len(w), sum(counts[1][(x,)] > 0 for x in w), size, base, full)
    return out


@pytest.mark.parametrize("kept", [1 << 20, 300, 0])
def test_scores_like_the_recursion(spark, kept):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model, words = lm.train(docs.filter(~lm.held_out()), kept=kept)
    found = {r["doc_id"]: tuple(r)[1:] for r in lm.score(docs, model, words, lm.held_out()).collect()}
    expected = plain_scores(texts_of(docs), kept)
    assert found.keys() == expected.keys()
    for i, row in expected.items():
        assert found[i][:4] == row[:4]
        assert found[i][4:] == pytest.approx(row[4:], rel=1e-9)
    if kept > 1000:
        held = [r for r in found.values() if r[0]]
        assert sum(r[5] for r in held) > sum(r[4] for r in held)


@pytest.mark.parametrize("cached", [1 << 20, 300, 0])
def test_query_scores_keep_every_ngram(spark, monkeypatch, cached):
    """A corpus with more n-grams than a task holds gets the scores of all of them, those seen once too."""
    monkeypatch.setattr(lm, "KEPT", cached)
    texts = texts_of(spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    tokens = {i: [None, None, *lowered(t), b" end "] for i, t in texts}
    trained = [w for i, w in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    ones = Counter(x for w in trained for x in w[2:])
    twos = Counter((w[k - 1], w[k]) for w in trained for k in range(3, len(w)))
    threes = Counter(tuple(w[k - 2 : k + 1]) for w in trained for k in range(4, len(w)))
    after = Counter(g[:-1] for g in [*twos, *threes])
    times = Counter()
    for g, n in [*twos.items(), *threes.items()]:
        times[g[:-1]] += n

    def chance(history, word):
        if not history:
            return (ones[word] + 1) / ones_total
        lower = chance(history[1:], word)
        if not times[history]:
            return lower
        n = (twos if len(history) == 1 else threes)[(*history, word)]
        return (max(n - lm.DISCOUNT, 0) + lm.DISCOUNT * after[history] * lower) / times[history]

    size = sum(ones.values())
    ones_total = size + len(ones) + 1
    rows = {r["doc_id"]: r for r in lm.op5_lm_score(spark, TESTDATA).collect()}
    assert rows.keys() == tokens.keys()
    for i, w in tokens.items():
        full = sum(math.log10(chance(tuple(x for x in w[k - 2 : k] if x is not None), w[k])) for k in range(2, len(w)))
        base = sum(math.log10((ones[x] + 1) / ones_total) for x in w[2:])
        row = rows[i]
        assert (row["n_tokens"], row["train_tokens"], row["n_known"]) == (len(w) - 2, size, sum(ones[x] > 0 for x in w[2:]))
        assert (row["base_score"], row["score"]) == pytest.approx((base, full), rel=1e-9)


def test_whole_scores_of_odd_documents(odd_docs, no_docs):
    rows = lm.whole_scores(odd_docs, lm.held_out()).collect()
    assert len(rows) == 14 and all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    rows = lm.whole_scores(odd_docs, F.lit(True)).collect()
    assert {(r["n_known"], r["base_score"], r["score"]) for r in rows} == {(0, 0.0, 0.0)}
    assert lm.whole_scores(no_docs, lm.held_out()).count() == 0


def test_scores_of_odd_documents(odd_docs, no_docs):
    model, words = lm.train(odd_docs)
    rows = lm.score(odd_docs, model, words, lm.held_out()).collect()
    assert len(rows) == 14 and all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    model, words = lm.train(no_docs)
    rows = lm.score(odd_docs, model, words, lm.held_out()).collect()
    assert {(r["n_known"], r["base_score"], r["score"]) for r in rows} == {(0, 0.0, 0.0)}
    assert lm.score(no_docs, model, words, lm.held_out()).count() == 0


# sharding


def test_shards_are_even_and_gapless(spark, make_docs):
    same = [(i, PROSE, "en", "s") for i in range(1500)]
    rows = same + [(i, sentence(i, 5 + i % 60), "en", "s") for i in range(1500, 6000)]
    docs = make_docs(rows)
    found = sharding.shard(docs, shards=8).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, *_ in rows)
    sizes, slots, shards_of = Counter(), defaultdict(list), defaultdict(set)
    for r in found:
        text = rows[r["doc_id"]][1]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        shards_of[text].add(r["shard"])
    assert len(sizes) == 8 and max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in shards_of.values()) == 1  # the group that is larger than a shard
    assert sorted(map(tuple, found)) == sorted(map(tuple, sharding.shard(docs, shards=8).collect()))


def test_shards_of_odd_documents(odd_docs, no_docs):
    found = sharding.shard(odd_docs).collect()
    assert len(found) == 14 and all(0 <= r["shard"] < 40 for r in found)
    assert len({(r["shard"], r["slot"]) for r in found}) == 14
    assert sharding.shard(no_docs).count() == 0


# quality


def plain_quality(text):
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(odd_docs, no_docs, make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("ab\nc#d", k=rng.randint(0, 80))), "en", "s") for i in range(200)]
    for docs in (odd_docs, make_docs(rows)):
        found = Counter(tuple(r)[:6] for r in quality_rules.judge_quality(docs).collect())
        assert found == Counter((i, *plain_quality(t)) for i, t in texts_of(docs))
    assert quality_rules.judge_quality(no_docs).count() == 0


def test_order_of_rules_does_not_change_verdicts(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("text")
    rules, kept = list(quality_rules.RULES), set()
    for order in (rules, rules[::-1], quality_rules.ordered_rules(docs)):
        assert sorted(r.name for r in order) == sorted(r.name for r in rules)
        kept.add(docs.filter(quality_rules.all_hold(order, quality_rules.measures(F.col("text")))).count())
    assert len(kept) == 1


# benchmark


def test_benchmark_windows_like_all_windows(spark, make_docs):
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.choice([3, 6, 15, 30])))) for i in range(25)]
    items += [(90, ""), (91, None), (92, items[3][1])]
    rows = []
    for i in range(120):
        words = sentence(i, rng.randint(0, 40)).split()
        if i % 2:
            piece = rng.choice(items[:25])[1].split()
            if i % 4 == 1 and len(piece) > 20:
                piece[rng.randrange(2, len(piece))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if i % 3 else w for w in piece]
        rows.append((i, " ".join(words), "en", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")

    def shingled(words):
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])

    expected = set()
    for i, text, _, _ in rows:
        words = lowered(text)
        for item, t in items:
            own = lowered(t or "")
            for s in range(max(1, len(words) - len(own) + 1)) if own and words else ():
                other = words[s : s + len(own)]
                if len(other) < 0.8 * len(own):
                    continue
                a, b = shingled(own), shingled(other)
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                    expected.add((i, item))
    docs = make_docs(rows)
    found = decontamination.contaminations(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected
    clean = decontamination.decontaminate(docs, bench)
    assert clean.dtypes == docs.dtypes
    assert {r["doc_id"] for r in clean.collect()} == {i for i, *_ in rows} - {i for i, _ in expected}


def test_benchmark_blocks_and_odd_documents(spark, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(1, PROSE), (2, "short text"), (3, "nowhere at all to be found")], "item_id long, text string")
    whole = sorted(map(str, decontamination.contaminations(odd_docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 1)
    assert sorted(map(str, decontamination.contaminations(odd_docs, bench).collect())) == whole
    assert len(whole) == 5
    assert decontamination.contaminations(odd_docs, bench.limit(0)).count() == 0
    assert decontamination.decontaminate(no_docs, bench).count() == 0
    assert decontamination.decontaminate(odd_docs, bench.limit(0)).count() == 14


# near duplicates


def plain_components(docs):
    sets = {}
    for i, text in docs:
        words = lowered(text)
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("small", [16, 2])
def test_components_like_all_pairs(make_docs, monkeypatch, small):
    monkeypatch.setattr(near_dup, "SMALL", small)
    rng, rows = random.Random(8), []
    for group in range(12):
        base = sentence(group, 120).split()
        for copy in range(1 + group * 2):
            words = list(base)
            for _ in range(copy % 3):
                words[rng.randrange(len(words))] = f"new{len(rows)}"
            rows.append((len(rows), " ".join(words).upper() if copy % 2 else " ".join(words), "en", "s"))
    rng.shuffle(rows)
    docs = make_docs(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect()}
    expected = plain_components([(i, t) for i, t, _, _ in rows])
    assert found == expected  # buckets of three are split already with 2; what that loses the exact rest finds
    kept = near_dup.deduplicate(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in found.values()})


def test_pages_on_one_template_like_all_pairs(make_docs):
    """Pages that are alike by 0.6, some with a near copy that shares large buckets only with the others."""
    rng, rows, base = random.Random(21), [], sentence(3, 150).split()
    for page in range(1500):
        words = base + [f"own{page}x{k}" for k in range(42)]
        rows.append((len(rows), " ".join(words), "en", "s"))
        if page % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            words[rng.randrange(len(words))] = "also"
            rows.append((len(rows), " ".join(words), "en", "s"))
    rng.shuffle(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(make_docs(rows)).collect()}
    # Own words keep pages apart, so only a page and its copy need be compared.
    families = {}
    for i, t, _, _ in rows:
        families.setdefault(next(w for w in t.split() if w.startswith("own")).split("x")[0], []).append((i, t))
    expected = {k: v for family in families.values() for k, v in plain_components(family).items()}
    assert len(set(c for _, c in expected.values())) < len(rows)
    assert found == expected


def test_components_of_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(odd_docs).collect()]
    assert len(rows) == 14
    assert Counter(rows)[2, len(lowered(PROSE)) - 4, 1] == 2
    assert (None, 1, None) in rows and (None, 0, None) in rows and (3, 0, 3) in rows and (6, 1, 6) in rows
    kept = near_dup.deduplicate(odd_docs)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, 4, 5, None, None, 6, 7, 8, 9, 10])
    assert near_dup.deduplicate(no_docs).count() == 0


# language


def test_parse_takes_longest_matches():
    text = "abracadabra"
    arcs = language.suffix_automaton(text)
    for word, n in (("abra", 1), ("abrac", 1), ("cabra", 2), ("z", 1), ("azbz", 4), ("", 0), ("dabraca", 2)):
        assert language.phrases(arcs, word) == n


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    told = language.identify(docs, docs.filter(~language.held_out())).filter(language.held_out())
    right = told.filter(F.col("language.lang") == F.col("lang")).count()
    assert right >= 0.95 * told.count()


def test_rare_label_and_copies_leave_the_others_their_samples(spark, make_docs):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    before = language.learn(docs)
    more = make_docs([(-1, "zu ok", "xx", "s"), *((-2 - k, "the same line again", "en", "s") for k in range(3000))])
    taught = docs.select("text", "lang").unionByName(more.select("text", "lang"))
    samples = language.learn(taught)
    assert samples["xx"] == " zu ok " and {k: len(v) for k, v in samples.items() if k not in ("xx", "en")} == {
        k: len(v) for k, v in before.items() if k != "en"
    }
    assert samples["en"].count("the same line again") <= 1 and len(samples["en"]) >= 0.9 * len(before["en"])
    told = language.identify(docs, taught.filter("text <> ''")).filter(language.held_out())
    assert told.filter(F.col("language.lang") == F.col("lang")).count() >= 0.95 * told.count()


def test_language_of_odd_documents(odd_docs, no_docs):
    name = "told"
    told = {r["doc_id"]: r[name] for r in language.identify(odd_docs, odd_docs, name).collect()}
    assert all(told[i] == ("und", 0.0, None) for i in (3, 4, 5, 10))
    assert told[1]["lang"] == "en" and 0 < told[1]["score"] <= 1
    assert {r[name]["lang"] for r in language.identify(odd_docs, no_docs, name).collect()} == {"und"}
    kept = language.accepted(odd_docs, odd_docs)
    assert 8 not in {r["doc_id"] for r in kept.collect()} or told[8]["bits"] <= language.MOST_BITS
    assert kept.dtypes == odd_docs.dtypes and not {3, 4, 5, 10} & {r["doc_id"] for r in kept.collect()}
    assert language.accepted(no_docs, odd_docs).count() == 0


def test_kept_words_digest(odd_docs):
    rows = substring.remove_repeats(odd_docs).select("kept", F.sha2("kept", 256).alias("d")).collect()
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["d"] for r in rows)
