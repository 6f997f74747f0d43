"""Byte-level BPE by a lazily determinised finite-state transducer, and a streaming decoder.

A row of tokens is what BPE makes of its bytes exactly if BPE makes of the bytes of every two
neighbours those two again: the first merge over a border would be made for the two alone as well. So
all prefixes of a word have one such row, and the rows of longer prefixes grow out of those of shorter
ones. This gives a transducer whose states are pairs (last token, place in the trie of tokens): reading
a byte moves down the trie, and where a token ends there that may follow the last one, it is put out.
It is determinised while it reads: a state of the result is the set of pairs that are still possible,
each with the tokens that not all of them agree on; what all agree on is emitted. So a token leaves as
soon as no continuation of the word can change it.

Whether a token may follow another is tested when a state first needs it. Within a token the piece that
touches the border is a byte first and the whole token last, and each change has the rank of a merge; BPE
merges across the border exactly if two pieces that are there at the same time have a rank together. That
needs ranks that grow from the parts of a token to the token; without them BPE is run over the two.

The ranks are those of a tiktoken file: the neighbours whose bytes together have the lowest rank merge
first, the leftmost of equals, and a word that is a token itself is that token. Words are the matches
of ``PATTERN``; which characters are letters, numbers and white space is asked of the library, since
engines know different versions of Unicode. Text that no match covers gives no tokens.

The decoder goes through ids with what is left of an unfinished character as its state, and hands out
whole characters only; ids may come in pieces of any size.

Null texts count as empty and have no tokens. Ids that repeat, ties, empty tables and other columns
need no special care: each row is encoded on its own and whole, and only its id and text are read.
A very long text takes memory in proportion to itself, a very long word also states.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession

from .common import kept, prepared, slim, task

RANKS = "byte_bpe_multi_50k.tiktoken"
#: States of the determinised transducer; more, and it starts anew.
STATES = 100_000
#: Words a worker remembers, and the longest of them; more, and it forgets those not met since.
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
#: Ids that are decoded together.
PIECE = 1 << 14

_NONE = -1
_GREAT = 1 << 62


def rank_file(name: str = RANKS) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read_ranks(text: str) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in text.splitlines() if line)}


# ------------------------------------------------------------------ words


def character_classes() -> dict[str, list[tuple[int, int]]]:
    """The ranges of code points that the library's engine takes for letters, numbers and white space."""
    import tiktoken

    alphabet = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    bytes_only = {bytes([b]): b for b in range(256)}
    out = {}
    for name in ("\\p{L}", "\\p{N}", "\\s"):
        finder = tiktoken.Encoding("class", pat_str=name + "+", mergeable_ranks=bytes_only, special_tokens={})
        points = np.array([ord(c) for c in bytes(finder.encode_ordinary(alphabet)).decode()])
        cut = np.flatnonzero(np.diff(points, prepend=-2) > 1)
        ends = np.append(cut[1:], len(points)) - 1
        out[name] = list(zip(points[cut].tolist(), points[ends].tolist()))
    return out


def word_pattern(pattern: str, classes: dict[str, list[tuple[int, int]]], top: int = 0x10FFFF) -> re.Pattern:
    """The pattern with its classes written out as ranges up to a code point, within brackets or as a class of their own."""
    listed = {
        name: "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in ranges if a <= top) for name, ranges in classes.items()
    }
    out, inside = [], False
    for piece in re.split(r"(\\p\{\w\}|\\[sS]|\[|\])", pattern):
        if piece in listed:
            out.append(listed[piece] if inside else f"[{listed[piece]}]")
        elif piece == "\\S":
            out.append(f"[^{listed['\\s']}]")
        else:
            inside = piece == "[" or (inside and piece != "]")
            out.append(piece)
    return re.compile("".join(out))


class Words:
    """The words of a text. Classes without the characters that a text has not are much faster to test."""

    def __init__(self, pattern: str, classes: dict[str, list[tuple[int, int]]]):
        self.ascii, self.basic, self.all = (word_pattern(pattern, classes, top).findall for top in (0x7F, 0xFFFF, 0x10FFFF))
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.all(text) if self.beyond(text) else self.basic(text)


# ------------------------------------------------------------------ encoder


class Transducer:
    """Encoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks = ranks
        self.most_states = states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.fits: dict[int, bool] = {}
        self._prepare_pieces()
        # the trie: edges by node << 8 | byte; the token that ends at a node; whether a node has edges
        self.edges: dict[int, int] = {}
        self.token_at = [_NONE]
        self.goes_on = [False]
        for token in sorted(ranks):
            node = 0
            for b in token:
                key = node << 8 | b
                if key not in self.edges:
                    self.edges[key] = len(self.token_at)
                    self.goes_on[node] = True
                    self.token_at.append(_NONE)
                    self.goes_on.append(False)
                node = self.edges[key]
            self.token_at[node] = ranks[token]
        self._start_anew()

    def _start_anew(self) -> None:
        start = ((_NONE, 0, ()),)
        self.members = [start]
        self.last: list[tuple[int, ...]] = [()]
        self.number = {start: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        if len(self.fits) > 10 * self.most_states:
            self.fits = {}

    def _go_on(self, state: int) -> int:
        """Forget all states but the first and the one given, even within a word; its new number."""
        members, last = self.members[state], self.last[state]
        self._start_anew()
        if state:
            self.number[members] = len(self.members)
            self.members.append(members)
            self.last.append(last)
        return len(self.members) - 1

    def merged(self, word: bytes) -> tuple[int, ...]:
        """BPE of a few bytes, merge by merge."""
        return tuple(self.ranks[p] for p in self._merge(word, 1))

    def _merge(self, word: bytes, least: int) -> list[bytes]:
        """The parts that are left when no two neighbours merge, or when there are but ``least``."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > least:
            found = [self.ranks.get(a + b, _GREAT) for a, b in zip(parts, parts[1:])]
            best = min(found)
            if best == _GREAT:
                break
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _prepare_pieces(self) -> None:
        """For each token that BPE forms, its pieces at either end: (bytes, rank from which it is there, rank at
        which it is gone), the byte first."""
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        self.formed: set[int] = set()
        self.growing = True
        for token, rank in sorted(self.ranks.items(), key=lambda item: len(item[0])):
            if len(token) == 1:
                self.formed.add(rank)
                continue
            last = self._last_merge(token)
            if last is None:
                continue
            self.formed.add(rank)
            parts[token] = last
            self.growing &= all(len(p) == 1 or (self.ranks[p] < rank and p in parts) for p in last)
        self.left: dict[int, list[tuple[bytes, int, int]]] = {}
        self.right: dict[int, list[tuple[bytes, int, int]]] = {}
        for token, rank in self.ranks.items() if self.growing else ():
            if rank not in self.formed:
                continue
            for side, ends in ((0, self.left), (1, self.right)):
                found, piece, gone = [], token, _GREAT
                while True:
                    there = -1 if len(piece) == 1 else self.ranks[piece]
                    found.append((piece, there, gone))
                    if len(piece) == 1:
                        break
                    piece, gone = parts[piece][side], there
                ends[rank] = found[::-1]

    def _last_merge(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts BPE of a token's bytes merges last, if it ends with the token."""
        parts = self._merge(token, 2)
        return (parts[0], parts[1]) if len(parts) == 2 and len(self._merge(token, 1)) == 1 else None

    def _crossed(self, last: int, token: int) -> bool:
        """Whether BPE merges across the border of two tokens."""
        get = self.ranks.get
        for x, x_there, x_gone in self.right[last]:
            for y, y_there, y_gone in self.left[token]:
                rank = get(x + y)
                if rank is not None:
                    time = max(rank, x_there, y_there)
                    # of equal ranks the merge further left goes first
                    if time < x_gone and time <= y_gone:
                        return True
        return False

    def may_follow(self, last: int, token: int) -> bool:
        """Whether BPE leaves two tokens as they are; of the first token, whether BPE forms it."""
        if last == _NONE or token not in self.formed:
            return token in self.formed
        known = self.fits.get(last << 32 | token)
        if known is None:
            if self.growing:
                known = not self._crossed(last, token)
            else:
                known = self.merged(self.bytes_of[last] + self.bytes_of[token]) == (last, token)
            self.fits[last << 32 | token] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after a byte and what is emitted on the way, found when first needed."""
        after: list[tuple[int, int, tuple[int, ...]]] = []
        whole: tuple[int, int, tuple[int, ...]] | None = None
        for last, node, held in self.members[state]:
            down = self.edges.get(node << 8 | byte)
            if down is None:
                continue
            token = self.token_at[down]
            # one row of tokens only covers all bytes so far
            if token != _NONE and whole is None and self.may_follow(last, token):
                whole = (token, 0, (*held, token))
            if self.goes_on[down]:
                after.append((last, down, held))
        if whole is None:
            raise ValueError(f"byte {byte} is no token of the table")
        after.append(whole)
        first = after[0][2]
        shared = len(first)
        for _, _, held in after:
            if not shared:
                break
            if len(held) < shared:
                shared = len(held)
            while held[:shared] != first[:shared]:
                shared -= 1
        emitted = first[:shared]
        # in order of the places where they start, so that equal sets are equal rows
        members = tuple([(last, node, held[shared:]) for last, node, held in after]) if shared else tuple(after)
        to = self.number.get(members)
        if to is None:
            to = self.number[members] = len(self.members)
            self.members.append(members)
            self.last.append(whole[2][shared:])
        out = self.steps[state << 8 | byte] = (to, emitted)
        return out

    def encode(self, word: bytes) -> list[int]:
        """The ids of one word."""
        alone = self.ranks.get(word)
        if alone is not None:
            return [alone]
        out: list[int] = []
        state, known = 0, self.steps.get
        for byte in word:
            step = known(state << 8 | byte)
            if step is None:
                if len(self.members) > self.most_states:
                    state = self._go_on(state)
                    known = self.steps.get
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += self.last[state]
        return out


class WordTable:
    """Words met before, each with its ids; the transducer reads the others."""

    def __init__(self, transducer: Transducer, words: Words, remembered: int = REMEMBERED):
        self.transducer, self.words = transducer, words
        self.remembered = remembered
        self.ids: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _new(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = tuple(self.transducer.encode(word.encode()))
        if len(word) <= LONGEST_REMEMBERED:
            if 2 * len(self.ids) >= self.remembered:
                self.older, self.ids = self.ids, {}
            self.ids[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        get = self.ids.get
        for word in self.words(text):
            ids = get(word)
            if ids is None:
                ids = self._new(word)
                get = self.ids.get
            out += ids
        return out


# ------------------------------------------------------------------ decoder

# bytes that follow a first byte; fixed by UTF-8
_FOLLOWING = [0] * 0xC2 + [1] * 30 + [2] * 16 + [3] * 5 + [0] * 11


class Decoder:
    """Bytes and text of ids that come in pieces; a character is handed out when it is whole."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.rest = b""

    def feed(self, ids: Iterable[int]) -> bytes:
        data = self.rest + b"".join(map(self.bytes_of.__getitem__, ids))
        cut = len(data) - self._unfinished(data)
        self.rest = data[cut:]
        return data[:cut]

    def _unfinished(self, data: bytes) -> int:
        """Bytes at the end that begin a character and lack its last ones."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if 0x80 <= byte < 0xC0:
                continue
            return back if _FOLLOWING[byte] >= back else 0
        return 0

    def finish(self) -> bytes:
        """What is left of a character that never became whole."""
        data, self.rest = self.rest, b""
        return data


def decoded_pieces(bytes_of: dict[int, bytes], ids: list[int], piece: int = PIECE) -> Iterator[bytes]:
    decoder = Decoder(bytes_of)
    for i in range(0, len(ids), piece):
        yield decoder.feed(ids[i : i + piece])
    yield decoder.finish()


# ------------------------------------------------------------------ tables


class Model:
    """What a worker needs of a rank file and a pattern."""

    def __init__(self, text: str, pattern: str, classes: dict[str, list[tuple[int, int]]]):
        ranks = read_ranks(text)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no byte-level vocabulary, bytes without a token: {missing[:5]}")
        transducer = Transducer(ranks)
        self.table = WordTable(transducer, Words(pattern, classes))
        self.bytes_of = transducer.bytes_of
        self.decimal = {rank: str(rank) for rank in self.bytes_of}


def broadcast_model(spark: SparkSession, path: str | None = None, pattern: str | None = None) -> Broadcast:
    """The rank file, the pattern and the character classes; all of a size that data do not change."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    given = (Path(path or rank_file()).read_text(), pattern, character_classes())
    return prepared(spark).sparkContext.broadcast(given)


def model_of(given: Broadcast) -> Model:
    text, pattern, classes = given.value
    return kept(f"transducer {hash((text, pattern))}", lambda: Model(text, pattern, classes))


def encode(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (array of token ids)."""
    given = broadcast_model(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(given)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = model.table.encode(batch.column(1)[row].as_py())
                columns = [batch.column(0)[row : row + 1], pa.array([ids], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])

    return slim(docs, text, id_column).mapInArrow(task(run, keeps=True), "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id, text. Null ids give a null text; bytes that are no
    UTF-8 become the replacement character."""
    given = broadcast_model(tokens.sparkSession, path, pattern)
    kinds = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = model_of(given).bytes_of
        for batch in batches:
            texts = [
                None if ids is None else "".join(p.decode("utf-8", "replace") for p in decoded_pieces(bytes_of, ids))
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=kinds)

    return tokens.select("doc_id", "ids").mapInArrow(task(run, keeps=True), "doc_id bigint, text string")


def round_trip(docs: DataFrame, text: str = "text", id_column: str = "doc_id", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, then decode the ids: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    given = broadcast_model(docs.sparkSession, path, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(given)
        for batch in batches:
            sizes, id_digests, digests = [], [], []
            for row in batch.column(1):
                ids = model.table.encode(row.as_py())
                decoded = hashlib.sha256()
                for piece in decoded_pieces(model.bytes_of, ids):
                    decoded.update(piece)
                sizes.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(model.decimal.__getitem__, ids)).encode()).hexdigest())
                digests.append(decoded.hexdigest())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(id_digests, pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return slim(docs, text, id_column).mapInArrow(task(run, keeps=True), out)
