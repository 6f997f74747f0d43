"""Byte-level BPE by speculation and verification, vectorised.

A text is cut into words by the usual byte-level pattern. For all new words of a batch together,
greedy longest match over a trie proposes tokens; then every adjacent pair of tokens is tested:
would BPE, run over the bytes of the two, ever merge across their border? If no pair would, BPE over
the word gives exactly the proposal, because before the first merge across any border all tokens
form independently. Only words with a failing pair are merged step by step.

The pair test needs no merging. Within a token, the piece that touches the border changes over time:
it is a byte first and the whole token last, and each change happens at the rank of a merge. A merge
of rank c crosses the border exactly if the pieces on both sides that it joins are there at time c.
This holds for vocabularies in which a merge ranks after the merges that make its parts; others are
refused. Tokens that BPE never forms from their own bytes are not proposed.

Null texts count as empty and give no tokens. Ids that repeat, empty tables and long texts need no
special care: each row is encoded on its own and whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import kept, prepared, slim, task, text_groups
from .segments import SegmentTable

# fixed values: the pattern of byte-level pre-tokenization
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = np.int64(1) << 30
_NEVER_RANK = 1 << 30


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def broadcast_vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary file's text; its size is that of one tokenizer and no matter of the data."""
    return prepared(spark).sparkContext.broadcast(Path(path or vocabulary_file()).read_text())


def byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with: printable ones themselves, the others
    the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary, given the text of its JSON file."""

    def __init__(self, vocabulary: str):
        data = json.loads(vocabulary)
        model, letters = data["model"], byte_letters()
        if model["type"] != "BPE" or (data.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("not a byte-level BPE vocabulary")
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i).encode() for i in range(self.size)]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = ids[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self._prepare_pairs()
        self._prepare_trie()
        # the library's own engine, as engines differ in which letters they know
        self._words = Split(Regex(WORDS), "isolated").pre_tokenize_str
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.table = SegmentTable(self._encode_segments, special=[t.encode() for t in self.special])

    # ------------------------------------------------------------------ tables

    def _prepare_pairs(self) -> None:
        table = np.array([(a * self.size + b, r, t, a, b) for (a, b), (r, t) in self.merges.items()], np.int64)
        table = table[np.argsort(table[:, 0])].reshape(-1, 5)
        self.pair_keys, self.pair_ranks = table[:, 0].copy(), table[:, 1].copy()
        made = np.full(self.size, -1, np.int64)
        left, right = np.full((2, self.size), -1, np.int64)
        token = table[:, 2]
        made[token], left[token], right[token] = table[:, 1], table[:, 3], table[:, 4]
        if len(np.unique(token)) < len(token) or (np.maximum(made[left[token]], made[right[token]]) >= made[token]).any():
            raise ValueError("a merge does not rank after the merges that make its parts")
        # the pieces at a token's right (left) end, the token first, and the rank at which each goes
        self.right_pieces, self.right_gone = self._pieces(right, made)
        self.left_pieces, self.left_gone = self._pieces(left, made)
        # a token is formed from its own bytes unless its parts merge otherwise before its own rank
        ok = np.ones(self.size, bool)
        ok[token] = ~self._crossed(left[token], right[token], made[token])
        for _ in range(self.right_pieces.shape[1] + self.left_pieces.shape[1] + 1):
            ok[token] &= ok[left[token]] & ok[right[token]]
        self.formed = ok

    def _pieces(self, side: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pieces, gone = [np.arange(self.size)], [np.full(self.size, _NEVER)]
        while True:
            last = pieces[-1]
            inner = np.where(last >= 0, side[last], -1)
            if (inner < 0).all():
                return np.stack(pieces, 1).astype(np.int32), np.stack(gone, 1).astype(np.int32)
            pieces.append(inner)
            gone.append(np.where(inner >= 0, made[last], -1))

    def _crossed(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE merges across the border of each pair, before the given rank."""
        out = np.zeros(len(a), bool)
        limit = np.full(len(a), _NEVER) if until is None else until
        for i in range(self.right_pieces.shape[1]):
            live = np.flatnonzero(self.right_pieces[a, i] >= 0)
            for j in range(self.left_pieces.shape[1]):
                live = live[(self.left_pieces[b[live], j] >= 0) & ~out[live]]
                if not len(live):
                    break
                x, y = a[live], b[live]
                key = self.right_pieces[x, i].astype(np.int64) * self.size + self.left_pieces[y, j]
                at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
                rank = self.pair_ranks[at]
                hit = self.pair_keys[at] == key
                # of equal ranks the merge further left goes first
                hit &= rank < np.minimum(self.right_gone[x, i], limit[live])
                hit &= rank <= self.left_gone[y, j]
                out[live[hit]] = True
        return out

    def _prepare_trie(self) -> None:
        edges: dict[int, int] = {}
        token_at = [-1]
        for i, data in enumerate(self.bytes_of):
            if not data or not self.formed[i] or i in self.special.values():
                continue
            node = 0
            for b in data:
                key = node << 8 | b
                node = edges.get(key, 0)
                if not node:
                    node = edges[key] = len(token_at)
                    token_at.append(-1)
            token_at[node] = i
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys = keys[order]
        self.edge_nodes = np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.token_at = np.array(token_at, np.int64)

    # ------------------------------------------------------------------ encoding

    def _longest(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at each byte and ends within its word, and its length."""
        token, length = np.full(len(data), -1, np.int64), np.zeros(len(data), np.int64)
        at, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        depth = 0
        while len(at):
            key = node << 8 | data[at + depth]
            edge = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            there = self.edge_keys[edge] == key
            at, node = at[there], self.edge_nodes[edge[there]]
            depth += 1
            found = self.token_at[node]
            full = found >= 0
            token[at[full]], length[at[full]] = found[full], depth
            more = at + depth < ends[at]
            at, node = at[more], node[more]
        return token, length

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Encode words that the pattern does not cut further; none is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        stops = np.cumsum(sizes)
        token, length = self._longest(data, np.repeat(stops, sizes))
        taken = np.zeros(len(data), bool)
        at, end = stops - sizes, stops
        while len(at):
            taken[at] = True
            at = at + length[at]
            more = at < end
            at, end = at[more], end[more]
        where = np.flatnonzero(taken)
        ids = token[where]
        owner = np.searchsorted(stops, where, "right")
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        failing = set(owner[inner[self._crossed(pairs // self.size, pairs % self.size)[back]]].tolist())
        cuts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        flat = ids.tolist()
        return [
            self.merge(w) if i in failing else tuple(flat[cuts[i] : cuts[i + 1]]) for i, w in enumerate(words)
        ]

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Exact BPE of one word: always the merge of lowest rank, the leftmost of equals."""
        ids = [int(self.byte_ids[b]) for b in word]
        n = len(ids)
        if n <= 64:
            return self._merge_short(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return tuple(t for t in ids if t >= 0)

    def _merge_short(self, ids: list[int]) -> tuple[int, ...]:
        """The same without a heap, which pays only for long words."""
        get, none = self.merges.get, (_NEVER_RANK, -1)
        found = [get(p, none) for p in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), none)
        return tuple(ids)

    def _cut(self, segment: str) -> list[str]:
        """The words of a segment; special tokens stand alone."""
        if self._specials is None or not self._specials.search(segment):
            return [w for w, _ in self._words(segment)]
        out: list[str] = []
        for part in filter(None, self._specials.split(segment)):
            out += [part] if part in self.special else [w for w, _ in self._words(part)]
        return out

    def _encode_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cuts = [self._cut(s.decode()) for s in segments]
        words = [w for w in set(chain.from_iterable(cuts)) if w not in self.special]
        known = dict(zip(words, self.encode_words([w.encode() for w in words]))) if words else {}
        known |= {w: (i,) for w, i in self.special.items()}
        parts = [known[w] for w in chain.from_iterable(cuts)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.fromiter(chain.from_iterable(parts), np.int32, int(sizes.sum()))
        total = np.concatenate([[0], np.cumsum(sizes)])
        words_of = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts)))
        return ids, np.diff(total[np.concatenate([[0], words_of])])

    def encode_bytes(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts raw[ends[i]:ends[i + 1]], and the text borders among them. Special tokens
        written in a text become their ids."""
        return self.table.encode(raw, ends)

    def encode(self, texts: list[str]) -> list[list[int]]:
        data = [t.encode() for t in texts]
        ends = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
        ids, cuts = self.encode_bytes(np.frombuffer(b"".join(data), np.uint8), ends)
        flat = ids.tolist()
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the tokens, special ones included."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decoded_text(self, ids: list[int]) -> str:
        return self.decode(ids).decode("utf-8", "replace")


def codec_of(vocabulary: Broadcast) -> Codec:
    """The worker's codec for a broadcast vocabulary, built once."""
    return kept(f"bpe {hash(vocabulary.value)}", lambda: Codec(vocabulary.value))


def _id_lists(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (array of token ids)."""
    vocabulary = broadcast_vocabulary(docs.sparkSession, path)

    def run(batches):
        codec = codec_of(vocabulary)
        for batch in batches:
            for keys, raw, ends in text_groups(batch):
                found = _id_lists(*codec.encode_bytes(raw, ends))
                yield pa.RecordBatch.from_arrays([keys, found], names=["doc_id", "ids"])

    return slim(docs, text, id_column).mapInArrow(task(run, keeps=True), "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id, text. Null ids give a null text; bytes that are no
    UTF-8 become the replacement character."""
    vocabulary = broadcast_vocabulary(tokens.sparkSession, path)
    kinds = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        codec = codec_of(vocabulary)
        for batch in batches:
            texts = [None if i is None else codec.decoded_text(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=kinds)

    return tokens.select("doc_id", "ids").mapInArrow(task(run, keeps=True), "doc_id bigint, text string")


def round_trip(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Encode, then decode the ids: doc_id, n_tokens, ids_sha256 and decoded_sha256, and ids if asked."""
    vocabulary = broadcast_vocabulary(docs.sparkSession, path)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        codec = codec_of(vocabulary)
        for batch in batches:
            for keys, raw, ends in text_groups(batch):
                ids, cuts = codec.encode_bytes(raw, ends)
                flat = ids.tolist()
                lists = [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                columns = [
                    keys,
                    pa.array(np.diff(cuts), pa.int64()),
                    pa.array([_digest(b",".join(map(codec.decimal.__getitem__, i))) for i in lists], pa.string()),
                    pa.array([_digest(codec.decoded_text(i).encode()) for i in lists], pa.string()),
                    *[_id_lists(ids, cuts)] * with_ids,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return slim(docs, text, id_column).mapInArrow(task(run, keeps=True), out)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
