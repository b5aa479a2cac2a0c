"""What a task holds: bounded, and enough to go on with."""

import random

from tidemark.llm import graph, token_files
from tidemark.llm.text import settle


def test_encoder_forgets_words_that_do_not_come_again(monkeypatch):
    """The memory for words stays within its slots; frequent words are asked for once, and ids are the tokenizer's."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "SLOTS", 1 << 10)
    path, asked = token_files.tokenizer_path(), []
    plain, encoder = Tokenizer.from_file(path), token_files.Encoder(path)
    ask = encoder._parts
    monkeypatch.setattr(encoder, "_parts", lambda parts, heads: (asked.extend(parts), ask(parts, heads))[1])
    common = [f"common{i}" for i in range(200)]
    for at in range(30):
        text = " ".join(["start", *common, *(f"rare{at}x{i}" for i in range(100))])
        [octets] = encoder.encode([text])
        ids = plain.encode(text, add_special_tokens=False).ids
        assert octets == b"".join(i.to_bytes(4, "little") for i in ids)
        assert encoder.table.n <= len(encoder.start) == 1 << 10
    assert all(asked.count(word) == 1 for word in common)


def test_encoder_asks_for_new_words_together(monkeypatch):
    """New words, with signs or line feeds in them too, come to the tokenizer in few texts; ids are the tokenizer's."""
    from tokenizers import Tokenizer

    path, asked = token_files.tokenizer_path(), []
    plain, encoder = Tokenizer.from_file(path), token_files.Encoder(path)
    ask = encoder._coded
    monkeypatch.setattr(encoder, "_coded", lambda pieces: (asked.extend(pieces), ask(pieces))[1])
    forms = "né{}w, x{}.\nY '{}'s ({}) 中{}<|endoftext|> \u0120{} <|endoftext|>{}".split(" ")
    texts = [" ".join(["start", *(form.format(i) for form in forms for i in range(at, at + 100))]) for at in (0, 50, 100)]
    for text, octets in zip(texts, encoder.encode(texts)):
        assert octets == b"".join(i.to_bytes(4, "little") for i in plain.encode(text, add_special_tokens=False).ids)
    assert len(asked) <= 200 * len(forms) // 50


def test_encoder_without_tokens_that_begin_with_a_blank():
    """Words that can't be told apart by their tokens are asked for one by one."""
    encoder = token_files.Encoder(token_files.tokenizer_path())
    expected = encoder.encode(["some words, and 2 more"])
    encoder._forget()
    encoder.blank[:] = False
    assert encoder.encode(["some words, and 2 more"]) == expected


def test_components_are_known_without_a_round_that_changes_nothing(spark, monkeypatch):
    """Stars are told by one grouped table; chains, rings and repeated links come to their smallest node."""
    edges, written = [(7, 3), (3, 9), (3, 9), (4, 4)], []
    monkeypatch.setattr(graph, "settle", lambda df: (written.append(df), settle(df))[1])
    found = graph.components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(3, 3), (7, 3), (9, 3)} and len(written) == 2
    rng = random.Random(5)
    chain = rng.sample(range(100, 400), 300)
    edges = [*zip(chain, chain[1:]), *((a, 500 + (a - 499) % 50) for a in range(500, 550)), (1, 2), (2, 1)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {n: 100 for n in chain} | {n: 500 for n in range(500, 550)} | {1: 1, 2: 1}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
