"""Byte-level BPE by last-token states over sorted words (a trie walk)."""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import ship, tidy

#: Fixed value: the split of the byte-level vocabularies, before the merges.
PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts of ASCII alone.
ASCII = r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Words that a worker remembers at least, and twice as many at most, beside a
#: slice's own: of two generations, the older one goes when the newer is full.
REMEMBERED = 100_000
#: Pairs of tokens whose fit, and steps between states, that a worker remembers.
PAIRS = 100_000
#: Characters of text worked on at once; a longer document is taken alone.
SLICE = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieBpe:
    """Encodes words by the last token of each of their prefixes.

    In BPE, the encoding of a prefix ends in one certain token, and a token t
    ends a prefix's encoding if and only if it fits behind the last token of
    what stands before t, that is, if the two are left alone when their joint
    bytes are encoded. The tokens that can end a prefix are its suffixes. So a node of the trie of words needs one state, found
    from the states above it, and words with a common prefix share the nodes of
    that prefix. Sorted words are the trie's depth-first order: the stack holds
    the states of the current path, and each word keeps what it shares.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank, self.made = {}, {}
        for i, (a, b) in enumerate(pairs):
            a, b = ids[as_bytes(a)], ids[as_bytes(b)]
            made = ids[as_bytes(pairs[i][0]) + as_bytes(pairs[i][1])]
            if made in self.made or any(self.made.get(x, (0, 0, -1))[2] > i for x in (a, b)):
                raise ValueError("a vocabulary whose tokens have one merge each, later than their parts', is needed")
            self.rank[a << 32 | b] = i
            self.made[made] = (a, b, i)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._automaton(ids)
        # every token's bytes, one after the other
        bytes_of = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.size = np.zeros(max(bytes_of) + 1, np.int64)
        self.size[list(bytes_of)] = [len(t) for t in bytes_of.values()]
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(bytes_of.get(i, b"") for i in range(len(self.size))), np.uint8)
        self.fits: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.split, self.ascii = regex.compile(PATTERN), re.compile(ASCII)
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def _automaton(self, ids: dict[bytes, int]) -> None:
        """States for the tokens' prefixes: `step` to longer ones, `back` to the
        longest proper suffix that is one, and `ends`, the tokens (id, size) that
        a state's bytes end in, the longest first."""
        self.step, self.back, self.ends, self.stepped = {}, [0], [()], {}
        level = [(0, sorted(ids), 0)]
        while level:
            deeper = []
            for state, tokens, depth in level:
                for byte, group in itertools.groupby([t for t in tokens if len(t) > depth], key=lambda t: t[depth]):
                    group, new = list(group), len(self.back)
                    self.step[state << 8 | byte] = new
                    self.back.append(self.next(self.back[state], byte) if state else 0)
                    own = ((ids[group[0]], depth + 1),) if len(group[0]) == depth + 1 else ()
                    self.ends.append(own + self.ends[self.back[new]])
                    deeper.append((new, group, depth + 1))
            level = deeper
        self.stepped.clear()

    def next(self, state: int, byte: int) -> int:
        """The state of the longest suffix of a state's bytes and one more."""
        key = state << 8 | byte
        found = self.step.get(key)
        if found is None and state:
            found = self.stepped.get(key)
            if found is None:
                if len(self.stepped) > PAIRS:
                    self.stepped.clear()
                found = self.stepped[key] = self.next(self.back[state], byte)
        return found or 0

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token that are at its left (0) or right (1) edge, the
        byte first, each with the rank of the merge that takes it up."""
        out = self.spines[side].get(token)
        if out is None:
            parts, rank = [], float("inf")
            while token in self.made:
                parts.append((token, rank))
                rank = self.made[token][2]
                token = self.made[token][side]
            out = [(token, rank), *reversed(parts)]
            self.spines[side][parts[0][0] if parts else token] = out
        return out

    def fit(self, a: int, b: int) -> bool:
        """Whether a followed by b stays so. Merges come in order of rank, of one
        rank from left to right: the two are joined if at some time their edges
        are a pair whose turn comes before either edge is taken up inside its own
        token."""
        left, right, i, j = self.spine(a, 1), self.spine(b, 0), 0, 0
        while True:
            (x, own), (y, other) = left[i], right[j]
            rank = self.rank.get(x << 32 | y)
            if rank is not None and rank < own and rank <= other:
                return False
            if own == other == float("inf"):
                return True
            if own <= other:
                i += 1
            else:
                j += 1

    def walk(self, words: list[bytes]):
        """(word, its ids joined by commas) for sorted distinct words. A node has
        its automaton state, its last token and its whole encoding."""
        path, states, last, texts, known = b"", [0], [0], [""], self.fits
        step, ends = self.step, self.ends
        for word in words:
            keep, end = 0, min(len(path), len(word))
            if path[:end] == word[:end]:
                keep = end
            else:
                while path[keep] == word[keep]:
                    keep += 1
            del states[keep + 1 :], last[keep + 1 :], texts[keep + 1 :]
            state = states[keep]
            for end in range(keep + 1, len(word) + 1):
                byte = word[end - 1]
                state = step.get(state << 8 | byte) or self.next(state, byte)
                for token, size in ends[state]:
                    if size == end:
                        text = str(token)
                        break
                    pair = last[end - size] << 32 | token
                    fits = known.get(pair)
                    if fits is None:
                        if len(known) > PAIRS:
                            known.clear()
                            self.spines[0].clear()
                            self.spines[1].clear()
                        fits = known[pair] = self.fit(last[end - size], token)
                    if fits:
                        text = f"{texts[end - size]},{token}"
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                states.append(state)
                last.append(token)
                texts.append(text)
            path = word
            yield word, texts[-1]

    def learn(self, words: set[str]) -> None:
        """Remember the encodings of words."""
        raw = {w.encode("utf-8"): w for w in words}
        for word, ids in self.walk(sorted(raw)):
            self.words[raw[word]] = ids

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens, in order."""
        split = (self.ascii if text.isascii() else self.split).findall
        if not self.cut or not any(s in text for s in self.special):
            return split(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else split(part)
        return out

    def encode(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The ids of each text joined by commas, how many, and all ids."""
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, {}
        self.words |= {t: str(i) for t, i in self.special.items()}
        split = [self.pieces(t) for t in texts]
        new = set().union(*split) - self.words.keys()
        again = new & self.older.keys()
        self.words |= {w: self.older[w] for w in again}
        self.learn(new - again)
        known = self.words.__getitem__
        joined = [",".join(map(known, words)) for words in split]
        counts = np.array([x.count(",") + 1 if x else 0 for x in joined], np.int64)
        return joined, counts, np.fromstring(",".join([x for x in joined if x]), np.int64, sep=",")

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of so many ids each, in UTF-8; what is none is replaced."""
        size = self.size[ids]
        ends = np.cumsum(size)
        kind = np.int32 if not len(ends) or ends[-1] < 1 << 31 else np.int64
        at = np.repeat((self.first[ids] - (ends - size)).astype(kind), size)
        at += np.arange(len(at), dtype=kind)
        data = self.bytes[at].tobytes()
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(cut[:-1], cut[1:], strict=True)]


_LOADED: dict[str, TrieBpe] = {}


def encoder(path: str) -> TrieBpe:
    """One for each worker and file."""
    if path not in _LOADED:
        _LOADED[path] = TrieBpe(path)
    return _LOADED[path]


def bpe_encode(docs: DataFrame, path: str, with_ids: bool = False, slice_chars: int = SLICE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, array<int>, if asked
    for) of each row of docs (doc_id, text). `path` is a vocabulary file that
    every executor has. Every document's ids are decoded, its text is not looked
    at again. No shuffle; a worker holds one slice and a bounded word memory. Null
    text is empty: no tokens, digests of the empty string; null doc_id stays null;
    repeated rows are encoded each; an empty table gives no rows; other columns
    are ignored, whatever their names."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def run(batches):
        bpe, sha = encoder(path), lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size < slice_chars):
                    size += len(texts[b])
                    b += 1
                joined, counts, ids = bpe.encode(texts[a:b])
                columns = [keys[a:b], pa.array(counts), pa.array([sha(x.encode()) for x in joined]), pa.array([sha(x) for x in bpe.decode(ids, counts)])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                a = b

    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), schema)
