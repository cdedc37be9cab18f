import hashlib
import itertools
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratascore.llm.bpe import TokenMachine, byte_signs, compile_merges, decode, encode, has_arc, load_tokenizer, round_trip, text_of

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tables():
    return load_tokenizer(FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def merged(text, merges):
    """Byte-pair encoding as defined: each merge in order, from the left."""
    parts = [bytes([b]) for b in text]
    for u, v in merges:
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and parts[i] == u and parts[i + 1] == v:
                out.append(u + v)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_automaton_by_definition(seed):
    """Random merges over three letters, every string up to seven: one path each, that of the merges."""
    rng = random.Random(seed)
    made, merges = [b"a", b"b", b"c"], []
    while len(merges) < 12:
        u, v = rng.choice(made), rng.choice(made)
        if u + v not in made:
            merges.append((u, v))
            made.append(u + v)
    number = {label: i for i, label in enumerate(made)}
    plain = compile_merges(made, [(number[u], number[v], number[u + v]) for u, v in merges])
    machine = TokenMachine(plain | {"labels": made, "odd": "", "letter": "", "numeral": "", "added": {}})
    for size in range(1, 8):
        for text in map(bytes, itertools.product(b"abc", repeat=size)):
            want = merged(text, merges)
            assert [made[t] for t in machine.word(text)] == want
    for size in range(1, 5):  # the arcs accept what merging leaves as it is, and nothing else
        for tokens in itertools.product([t for t in range(len(made)) if plain["made"][t] >= 0], repeat=size):
            accepted = all(has_arc(plain, x, y) for x, y in itertools.pairwise(tokens))
            text = b"".join(made[t] for t in tokens)
            assert accepted == ([made[t] for t in tokens] == merged(text, merges))


def test_same_as_library(tables, library):
    machine = TokenMachine(tables)
    parts = ["a", "e", "the", " ", "  ", "\n", "\t", "é", "漢", "'", "'s", "!", "--", "<|endoftext|>", "<|endof", "1", "23", "²", "½",
             " ", "\u0085", "\x1c", "᠎", "🙂", "ing", "tion", "aaaa", "ी", "՘", "\U00010940", "﻿", "Ⅷ", "\x00"]
    rng = random.Random(2)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["a" * 9000, " " * 7001, "=-" * 3000, "é" * 4001, "\n" * 999 + "x", "0" * 5000]
    for text in texts:
        ids = list(machine.encode(text))
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert text_of(machine.labels, ids) == library.decode(want, skip_special_tokens=False)


def test_words_of_all_characters(tables, library):
    """Every code point is cut as the library cuts it, those of scripts in use beside a letter, a numeral and a blank too."""
    machine = TokenMachine(tables)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(points[start:start + 4096]) for start in range(0, len(points), 4096)]
    texts += ["".join(f"a{c}1{c} {c}!" for c in points[start:start + 512]) for start in range(0, 0x1000, 512)]
    for text in texts:
        cuts = [span for _, span in library.pre_tokenizer.pre_tokenize_str(text)]
        assert machine.split(text) == [text[a:b] for a, b in cuts]


def test_decode_of_any_ids(tables, library):
    """Ids that encoding never gives: broken UTF-8, ids out of range."""
    machine, rng = TokenMachine(tables), random.Random(3)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 12))]
        assert text_of(machine.labels, ids) == library.decode(ids, skip_special_tokens=False)
    assert text_of(machine.labels, [-1, 10**6]) == "" == text_of(machine.labels, [])


def test_query_on_edges(spark, edges, tables, library):
    rows = edges.select("doc_id", "text").collect()
    got = [tuple(r) for r in round_trip(edges, tables).collect()]
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), back)]
        want.append((r.doc_id, len(ids), *digests))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_general_interface(spark, no_docs, corpus, tables):
    """Texts and ids come out as they are, other key types and names too; an empty table gives no rows."""
    named = corpus.selectExpr("concat('k', doc_id) AS id", "text AS body", "lang AS ids", "source AS decoded")
    got = decode(encode(named, tables, "body", "id"), tables).collect()
    texts = {r.id: r.body for r in named.collect()}
    assert len(got) == len(texts) and all(r.decoded == texts[r.id] for r in got)
    odd = spark.createDataFrame([([64, None, 65],), (None,), ([],)], "ids array<int>")
    assert sorted(r.decoded for r in decode(odd, tables).collect()) == ["", "", "ab"]
    empty = decode(encode(no_docs, tables), tables)
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.collect() == []


def test_bounded_memory(tables, monkeypatch):
    import stratascore.llm.bpe as bpe

    machine = TokenMachine(tables)
    words = [f"w{i}x{i * 7}" for i in range(60)]
    want = [list(machine.encode(" ".join(words[k:]))) for k in range(0, 60, 7)]
    monkeypatch.setattr(bpe, "WORDS", 20)
    monkeypatch.setattr(bpe, "ARCS", 15)
    small = TokenMachine(tables)
    assert [list(small.encode(" ".join(words[k:]))) for k in range(0, 60, 7)] == want
    assert len(small) <= 20 and len(small.arcs) <= 15


def test_other_files_are_errors(tmp_path):
    with open(FILE, encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        load_tokenizer(str(tmp_path / "t.json"))
    assert len(byte_signs()) == 256 and set(byte_signs().values()) == set(range(256))
