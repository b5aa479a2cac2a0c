"""Words that the polynomial hash does not tell apart; languages learned from all labelled text, and at what cost."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, substring
from tidemark.llm.tokens import word_hashes


def _thue_morse(first, second, n):
    word = first
    while len(word) < n:
        word += word.translate(str.maketrans(first + second, second + first))
    return word


@pytest.mark.parametrize("most", [2_000, 0])
def test_substring_dedup_tells_words_of_equal_hash_apart(make_docs, monkeypatch, most):
    """Thue-Morse words have equal polynomials modulo 2**64 whatever the base."""
    monkeypatch.setattr(substring, "MOST_KINDS", most)
    one, other = _thue_morse("a", "b", 4096), _thue_morse("b", "a", 4096)
    hashes, _ = word_hashes([one, other])
    assert one != other and hashes[0] == hashes[1]
    before = " ".join(f"p{i}" for i in range(11))
    rows = [(1, f"{before} {one}"), (2, f"{before} {other}"), (3, f"x {before} {one}"), (4, f"y z {before}")]
    docs = make_docs([(i, text, "en", "a") for i, text in rows])
    found = {r["doc_id"]: tuple(r)[1:] for r in substring.remove_repeats(docs, 12).collect()}
    assert found == {1: (12, 12, ""), 2: (12, 0, rows[1][1]), 3: (13, 12, "x"), 4: (13, 0, rows[3][1])}


def test_equal_words_have_equal_hashes_wherever_they_lie():
    text = " ".join(f"w{i % 9973}" for i in range(900_000))
    hashes, _ = word_hashes([text])
    assert (hashes[: 9973 * 90].reshape(-1, 9973) == hashes[:9973]).all()


def test_language_is_learned_from_all_text(spark):
    """A word that only few of very many texts hold is counted in all of them, from any place in the text."""
    rows = [(" ".join(f"{a}{b}{c}{d}" for a in "abcd" for b in "efg" for c in "hij" for d in "kl") + f" own{i:04}", "aa") for i in range(1500)]
    rows = [(f"{text} zzqq" if i % 3 == 0 else text, lang) for i, (text, lang) in enumerate(rows)]
    rows += [(rows[1][0], "aa")] * 500
    labelled = spark.createDataFrame(rows, "text string, lang string")
    counts = {r["piece"]: int(r["n"]) for r in language.counted(labelled).filter("NOT gram").collect()}
    assert counts["zzqq"] == 500 * language.WEIGHT and counts["aehk"] == pytest.approx(1500 * language.WEIGHT, rel=1e-6)
    samples = language.learn(labelled)
    assert " zzqq " in samples["aa"] and " aehk " in samples["aa"] and "\nown" not in samples["aa"]


def test_limits_come_from_all_text_of_a_label(spark):
    """Of 1 000 texts 6 in 100 need many bits, fewer than a limit of OWN_SHARE leaves out; with 4 more it must rise."""
    odd = [" ".join("".join(chr(0x4E00 + (7 * i * k + j) % 3900) for j in range(3)) for k in range(1, 50)) for i in range(1, 121)]
    plain = [(f"the same few words again {'and again ' * (i % 90)}", "en") for i in range(880)]
    samples = {"en": " the same few words again and "}
    for n, higher in ((20, False), (120, True)):
        docs = spark.createDataFrame([*plain, *((t, "en") for t in odd[:n])], "text string, lang string")
        told = docs.withColumn("told", language.predicted(spark, samples))
        assert bool(language._limits(told, "told", language.MOST_BITS)) == higher


def test_documents_are_accepted_alike_if_the_labelled_are_some_of_them(odd_docs):
    taught = F.col("source") == "a"
    apart, among = (language.accepted(odd_docs, odd_docs.filter(taught), among=a).collect() for a in (None, taught))
    assert sorted(map(str, apart)) == sorted(map(str, among)) and apart


def test_language_task_counts_each_piece_once():
    """Many different words are no reason to send the frequent ones again and again."""
    words = [f"{'abcdefgh'[n % 8]}{''.join('ijklmnopqr'[int(d)] for d in str(n))}" for n in range(120_000)]
    texts = [" ".join(["und", *words[at : at + 100], "Und,"]) for at in range(0, len(words), 100)]
    rows = pa.table({"text": texts, "lang": ["de"] * len(texts), "weight": pa.array([3] * len(texts), pa.int64())})
    found = pa.Table.from_batches(language._count(iter(rows.to_batches(max_chunksize=100)))).to_pylist()
    counts = {(r["gram"], r["piece"]): r["n"] for r in found}
    assert len(counts) == len(found)
    assert counts[False, "und"] == 3 * 2 * len(texts) and counts[True, "und"] == counts[False, "und"]
    assert counts[False, None] == 3 * sum(len(word) + 1 for text in texts for word in text.replace(",", "").split())


def test_language_parses_alike_words_once():
    parser = language.Parser({"de": " und der die ", "en": " and the of "})
    told = list(parser.predictions(["Und der", "und, (DER)", "1 2", None, "", "\x0bthe \x1d the\tof"]))
    assert told[0][:2] == told[1][:2] and [t[0] for t in told] == ["de", "de", "und", "und", "und", "en"]
    assert sorted(parser.rows) == ["", "der", "of", "the", "und"]
