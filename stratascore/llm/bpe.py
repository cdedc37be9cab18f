"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens: its states say which token may follow which, so that every byte string has
one path, the one byte-pair encoding gives. It starts with one state and an arc for each byte. Each merge
(u, v) -> w, in order, adds one gadget: every state with an arc u gets an arc w to where v leads from
there, and the state behind u is split off and loses its arc v. All arcs of one label lead to one state,
so a state is named by its label. The arcs of w are those of u at the time of the merge, and its state
is the one of v then; both are kept as that default, and only lost arcs are listed. An arc that is
asked for is read off the gadgets once and then stands in the table of arcs.

A word is encoded by following arcs, the longest label that fits first. A position of the word belongs
to one path only, so a position without a way on is marked and never tried again: work is linear in the
length of the word. Words repeat, so each worker keeps the codes of the last ``WORDS`` to twice as many.

Texts are cut into words by the pattern of the byte-level vocabularies. What counts as a letter there
depends on the Unicode version of the library that defines it, so the library is asked once for all
code points.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 100_000
ARCS = 1 << 20
OUT_TOKENS = 1 << 19  # tokens of one output batch, after which the next text begins a new one
MOST_TOKENS = 1 << 20
ALWAYS = 1 << 40
ASKED = 1 << 12  # code points in one question to the library


def byte_signs() -> dict[str, int]:
    """The sign of each byte in a byte-level vocabulary: itself if it prints, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranges(points: Sequence[int]) -> str:
    """A character class of code points in rising order."""
    at = np.asarray(points, dtype=np.int64)
    breaks = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.r_[0, breaks + 1]] if len(at) else at, at[np.r_[breaks, -1]] if len(at) else at
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))


def word_pattern(letter: str = r"\p{L}", numeral: str = r"\p{N}", blank: str = r"\s") -> str:
    """How byte-level vocabularies cut a text into words (fixed)."""
    other = rf"[^{blank}{letter}{numeral}]+"
    return rf" ?[{letter}]+| ?[{numeral}]+|'(?:[stmd]|re|ve|ll)| ?{other}|[{blank}]+(?![^{blank}])|[{blank}]+"


def _classes_of(splitter) -> tuple[str, str, str]:
    """The library's letters and numerals, and the code points on which ``regex`` is of another mind."""
    import regex

    signs = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000)
    cut = splitter.pre_tokenize_str
    kinds: dict[str, set[str]] = {"a": set(), "1": set()}
    for start in range(0, len(signs), ASKED):
        asked = signs[start : start + ASKED]
        for _, (first, end) in cut(asked):  # a stretch of one kind; the kind it goes on from is its own
            for lead, theirs in kinds.items():
                if len(cut(lead + asked[first])) == 1:
                    theirs.update(asked[first:end])
    kinds = [(kinds["a"], set(regex.findall(r"\p{L}", signs))), (kinds["1"], set(regex.findall(r"\p{N}", signs)))]
    odd = set().union(*[theirs ^ ours for theirs, ours in kinds])
    letters, numerals, odd = (_ranges(sorted(map(ord, s))) for s in (kinds[0][0], kinds[1][0], odd))
    return f"A-Za-z{letters}", f"0-9{numerals}", odd


def compile_merges(labels: Sequence[bytes], merges: Sequence[tuple[int, int, int]]) -> dict:
    """The automaton of ``merges`` (left, right, made token), as plain tables; tokens no path has are left out."""
    size = len(labels)
    tables = {"size": size, "made": [-1] * size, "left": [-1] * size, "right": [-1] * size, "cut": {}}
    made, left, right, cut = tables["made"], tables["left"], tables["right"], tables["cut"]
    for token, label in enumerate(labels):
        if len(label) == 1:
            made[token] = 0
    for time, (u, v, w) in enumerate(merges, 1):
        if made[w] >= 0:
            raise ValueError(f"two merges make {labels[w]!r}")
        if made[u] < 0 or made[v] < 0 or not has_arc(tables, u, v):
            continue  # u and v never stand side by side: earlier merges take them apart
        made[w], left[w], right[w] = time, u, v
        cut[u * size + v] = time
        if u == v:
            cut[u * size + w] = time  # merging runs from the left, so u is not left over in front of its double
    return tables


def has_arc(tables: dict, x: int, y: int, before: int = ALWAYS) -> bool:
    """Whether the state of label ``x`` has an arc ``y``, seeing only what the gadgets before a time did.

    The label made last takes the answer over from an older one: an arc from its left part, a state from its right part.
    """
    size, made, left, right, lost = tables["size"], tables["made"], tables["left"], tables["right"], tables["cut"].get
    while lost(x * size + y, ALWAYS) >= before:
        if made[x] >= made[y]:
            if not made[x]:
                return True
            x, before = right[x], made[x]
        else:
            y, before = left[y], made[y]
    return False


def load_tokenizer(path: str) -> dict:
    """The automaton, ids, labels and word pattern of a byte-level tokenizer file, as plain tables.

    Anything else such files may hold (normalizers, other splitters, drop-out, unknown tokens, added
    tokens that take blanks with them) is an error, as are more than ``MOST_TOKENS`` tokens.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    added = spec["added_tokens"]
    bare = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not (plain and bare and spec["normalizer"] is None and (spec["decoder"] or {}).get("type") == "ByteLevel"
            and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)):
        raise ValueError("not a plain byte-level byte-pair encoding")
    vocabulary = model["vocab"] | {t["content"]: t["id"] for t in added}
    if max(vocabulary.values()) >= MOST_TOKENS:
        raise ValueError(f"more than {MOST_TOKENS} tokens")
    signs = byte_signs()
    labels = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        labels[number] = bytes(map(signs.__getitem__, token)) if all(c in signs for c in token) else token.encode()
    if not set(map(bytes, ([b] for b in range(256)))) <= {labels[n] for n in model["vocab"].values()}:
        raise ValueError("a byte without a token")
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = model["vocab"]
    tables = compile_merges(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
    letter, numeral, odd = _classes_of(Tokenizer.from_file(path).pre_tokenizer)
    contents = sorted((t["content"] for t in added), key=len, reverse=True)
    return tables | {
        "labels": labels, "letter": letter, "numeral": numeral, "odd": odd, "added": {t["content"]: t["id"] for t in added},
        "added_pattern": "|".join(map(re.escape, contents)),
    }


class TokenMachine(dict):
    """Encoder of one worker on the tables of ``load_tokenizer``; as a dict it holds the tokens of words it has met."""

    def __init__(self, tables: dict):
        super().__init__()
        import regex

        self.earlier: dict[str, tuple[int, ...]] = {}
        self.tables, self.labels, self.size = tables, tables["labels"], tables["size"]
        self.ids = {label: n for n, label in enumerate(self.labels) if tables["made"][n] >= 0}
        widths: dict[bytes, set[int]] = {}  # the widths of labels that begin with the same three bytes
        for label in self.ids:
            widths.setdefault(label[:3], {1, 2}).add(len(label))
        self.widths = {start: tuple(sorted(own, reverse=True)) for start, own in widths.items()}
        self.arcs: dict[int, bool] = {}
        self.words = regex.compile(word_pattern()).findall
        self.odd_words = regex.compile(word_pattern(tables["letter"], tables["numeral"])).findall
        self.is_odd = regex.compile(f"[{tables['odd']}]").search if tables["odd"] else lambda text: None
        self.low_words = None
        low = "".join(map(chr, range(256)))
        if self.is_odd(low) is None:  # one-byte texts are cut with plain classes, which takes under half of the time
            kinds = [_ranges(sorted(map(ord, regex.findall(kind, low)))) for kind in (r"\p{L}", r"\p{N}", r"\s")]
            self.low_words = re.compile(word_pattern(*kinds)).findall
        self.cut_added = re.compile(f"({tables['added_pattern']})").split if tables["added"] else None

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS:  # words that are met again before this happens next stay
            self.earlier = dict(self)
            self.clear()
        found = self.earlier.get(word)
        if found is None:
            found = self.word(word.encode("utf-8", "replace"))
        self[word] = found
        return found

    def arc(self, key: int) -> bool:
        if len(self.arcs) >= ARCS:
            self.arcs.clear()
        found = self.arcs[key] = has_arc(self.tables, *divmod(key, self.size))
        return found

    def word(self, word: bytes) -> tuple[int, ...]:
        """The labels on the one path that spells ``word``."""
        end, at, last, below = len(word), 0, -1, MOST_TOKENS
        path: list[int] = []
        closed: set[int] = set()
        ids, widths, labels, arcs, size = self.ids.get, self.widths.get, self.labels, self.arcs.get, self.size
        while at < end:
            for width in widths(word[at : at + 3], (2, 1)):
                stop = at + width
                if stop > end or width >= below or stop in closed:
                    continue
                token = ids(word[at:stop])
                if token is None:
                    continue
                if last >= 0:
                    key = last * size + token
                    known = arcs(key)
                    if not (self.arc(key) if known is None else known):
                        continue
                path.append(token)
                at, last, below = stop, token, MOST_TOKENS
                break
            else:  # no way on from here: back one label, to a shorter one
                closed.add(at)
                below = len(labels[path.pop()])
                at -= below
                last = path[-1] if path else -1
        return tuple(path)

    def split(self, text: str) -> list[str]:
        if self.low_words is not None:
            try:
                text.encode("latin-1")
                return self.low_words(text)
            except UnicodeEncodeError:
                pass
        return self.odd_words(text) if self.is_odd(text) else self.words(text)

    def encode(self, text: str | None) -> Iterator[int]:
        if not text:
            return iter(())
        added = self.tables["added"]
        if not any(content in text for content in added):
            return chain.from_iterable(list(map(self.__getitem__, self.split(text))))
        parts = self.cut_added(text)
        return chain.from_iterable((added[p],) if i % 2 else chain.from_iterable(map(self.__getitem__, self.split(p))) for i, p in enumerate(parts) if p)


def text_of(labels: Sequence[bytes], ids: Sequence[int]) -> str:
    """The labels one after the other, read as UTF-8; broken sequences become U+FFFD, ids without a label nothing."""
    try:
        if min(ids, default=0) < 0:
            raise IndexError
        emitted = list(map(labels.__getitem__, ids))
    except IndexError:
        emitted = [labels[i] for i in ids if 0 <= i < len(labels)]
    return b"".join(emitted).decode("utf-8", "replace")


def _machine(tables: dict) -> TokenMachine:
    """One machine per worker: it stays with the broadcast value, so the next task starts with its words."""
    if "machine" not in tables:
        tables["machine"] = TokenMachine(tables)
    return tables["machine"]


def encode(docs: DataFrame, tables: dict, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, ids`` of every row: the token ids of the whole text.

    Null and empty texts have no ids. Keys are passed on, null or repeated as they are; other columns
    are not read; an empty table gives an empty result. Nothing is shuffled; the tables are broadcast
    and hold at most ``MOST_TOKENS`` tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared.value)
        for batch in batches:
            first, ends, codes = 0, [0], array("i")
            for row, text in enumerate(batch.column(1)):
                codes.extend(machine.encode(text.as_py()))
                ends.append(len(codes))
                if len(codes) >= OUT_TOKENS or row + 1 == batch.num_rows:
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(codes, np.int32) if codes else [], pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, row + 1 - first), ids], [key, "ids"])
                    first, ends, codes = row + 1, [0], array("i")

    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text_"))
    return rows.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, tables: dict, ids: str = "ids") -> DataFrame:
    """``tokens`` with the column ``decoded``: the text of ``ids``. Null and empty lists give an empty text, null ids nothing."""
    shared = tokens.sparkSession.sparkContext.broadcast(tables["labels"])

    @F.arrow_udf("string")
    def texts(column: pa.Array) -> pa.Array:
        labels, at = shared.value, column.offsets.to_numpy()
        numbers = column.values.fill_null(-1).to_numpy(zero_copy_only=False)
        filled = column.is_valid().to_numpy(zero_copy_only=False)
        return pa.array([text_of(labels, numbers[a:b].tolist()) if ok else "" for a, b, ok in zip(at, at[1:], filled)], pa.string())

    return tokens.withColumn("decoded", texts(F.col(ids)))


def round_trip(docs: DataFrame, tables: dict) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the text they decode to."""
    done = decode(encode(docs, tables), tables)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
