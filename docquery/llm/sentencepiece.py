"""SentencePiece encoding and decoding, with a max-plus scan over the chunks of giant documents.

A text is cut into the pieces of a vocabulary so that the sum of their scores is greatest (the
unigram decoder's segmentation). That is a shortest-path problem, and paths compose: a chunk of
a text is a max-plus matrix from the state at its start (how many characters a piece from the
chunk before reaches into it) to the state at its end. So giant documents are cut into chunks
of a fixed size, each gets its matrix independently of the others, the matrices of a document are
combined by an associative scan, which gives the state at every chunk border, and each chunk is
then backtraced by itself. Only what lies before a chunk's first and after its last cut depends
on those states; the rest is cut into pieces beside the matrix. Chunks of a giant document are rows
of their own, spread over all tasks; short documents are one chunk and not shuffled at all.

Where no piece of the vocabulary has a word-start mark after another character, every word
start is a single state; inner words are then independent of the rest of the chunk, and a bounded
memo of words does most of the work.

Spaces become marks and one is put in front, as the model says. Characters outside the vocabulary
become byte pieces, and so does a mark that the text itself holds, so decoding gives back every
text exactly.

Defined results: null and empty texts have no pieces and decode to the empty text; rows are kept
one for one; of segmentations with equal scores one is chosen by fixed rules (within a chunk the
one whose last piece is longest; at a border the smallest state). doc_id may be of any type; other
columns are left aside, so their names don't matter. Very long texts are cut whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.llm.common import column, fresh, numbered, table, written

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk; longer documents are cut.
CHUNK = 16_384
MARK = "▁"
#: Stands for a mark that the text itself holds; lone surrogates can't occur in valid texts.
OWN_MARK = "\udc81"
UNKNOWN_PENALTY = 10.0
#: Words of at most so many characters are kept in a memo of so many entries.
MEMO_CHARS, MEMO_WORDS = 24, 150_000
LEAST = float("-inf")

Memo = dict[str, bytes]  # text -> its ids, packed as 32-bit integers
_memos: dict[int, tuple[Memo, Memo]] = {}  # by model: of words, and of parts of words


def _remember(memo: Memo, text: str, found: bytes) -> None:
    if len(text) <= MEMO_CHARS:
        if len(memo) >= MEMO_WORDS:
            memo.clear()
        memo[text] = found


class Trie:
    """The pieces as a table node x character -> node, over the characters most common in pieces.

    It segments many words at once: step k handles the k-th character of all of them.
    """

    MOST_CHARS = 31

    def __init__(self, model: PieceModel):
        often = Counter(chain.from_iterable(model.pieces))
        alphabet = sorted((c for c in often if c in model.pieces and ord(c) < 0x10000), key=lambda c: (-often[c], c))[:160]
        number = {c: k for k, c in enumerate(alphabet, 1)}
        nodes: dict[str, int] = {"": 0}
        links: list[tuple[int, int, int]] = []
        inside = [p for p in model.pieces if all(c in number for c in p)]
        for piece in inside:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    links.append((nodes[piece[: k - 1]], number[piece[k - 1]], nodes[piece[:k]]))
        self.child = np.full((len(nodes), len(alphabet) + 1), -1, np.int32)
        at = np.array(links).reshape(-1, 3)
        self.child[at[:, 0], at[:, 1]] = at[:, 2]
        self.score, self.id = np.full(len(nodes), LEAST), np.full(len(nodes), -1, np.int32)
        for piece in inside:
            self.score[nodes[piece]], self.id[nodes[piece]] = model.pieces[piece]
        self.number = np.zeros(0x10000, np.int32)
        self.number[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.plain = re.compile(f"[{re.escape(''.join(alphabet))}]{{1,{self.MOST_CHARS}}}").fullmatch
        self.reach = max(map(len, inside), default=1)

    def solve(self, words: list[str]) -> list[bytes]:
        """Packed ids of words of the alphabet, longest first; ties are cut as `PieceModel.forward` cuts them."""
        n = np.array([len(w) for w in words])
        width, wide = int(n[0]), self.child.shape[1]
        raw = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-16-le"), "<u2").reshape(len(words), width)
        code = np.zeros((width + self.reach, len(words)), np.int32)  # by place, so that a step reads neighbours
        code[:width] = self.number[raw].T
        score, back = np.full((width + 1, len(words)), LEAST), np.zeros((width + 1, len(words)), np.int32)
        piece = np.full((width + 1, len(words)), -1, np.int32)
        score[0] = 0.0
        child = self.child.ravel()
        for at in range(width):
            row = np.arange(np.searchsorted(-n, -at, side="left"))  # words longer than at
            node, till = child[code[at, : len(row)]], score[at, : len(row)]
            for to in range(at + 1, at + self.reach + 1):
                new = till + self.score[node]
                better = np.flatnonzero(new > score[to][row])
                which = row[better]
                score[to][which], back[to][which], piece[to][which] = new[better], at, self.id[node[better]]
                node = child[node * wide + code[to][row]]
                on = np.flatnonzero(node >= 0)
                if not len(on):
                    break
                row, node, till = row[on], node[on], till[on]
        every = np.arange(len(words))
        end = n.copy()
        ids, count = np.zeros((len(words), width), np.int32), np.zeros(len(words), np.int64)
        row = every
        while len(row):
            count[row] += 1
            ids[row, width - count[row]] = piece[end[row], row]
            end[row] = back[end[row], row]
            row = row[end[row] > 0]
        packed = ids.tobytes()
        return [packed[b - 4 * c : b] for b, c in zip(range(4 * width, len(packed) + 1, 4 * width), count.tolist(), strict=True)]


@dataclass(frozen=True)
class PieceModel:
    """Pieces with ids and scores, the ids of the 256 bytes, and whether a space goes in front."""

    pieces: dict[str, tuple[float, int]]
    spelled: list[bytes]  # id -> the bytes it stands for
    byte_ids: list[int]
    dummy_prefix: bool = True
    signature: int = 0
    longest: dict[str, int] = field(default_factory=dict)  # first character -> length of the longest piece

    @cached_property
    def reach(self) -> int:
        return max(self.longest.values(), default=1)

    @cached_property
    def unknown(self) -> float:
        return min((s for s, _ in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY

    @cached_property
    def words_apart(self) -> bool:
        return all(MARK not in p.lstrip(MARK) for p in self.pieces)

    @cached_property
    def inside(self) -> frozenset[str]:
        """All pairs of neighbouring characters in pieces; between any other pair every segmentation has a border."""
        return frozenset(p[k : k + 2] for p in self.pieces for k in range(len(p) - 1))

    @cached_property
    def word(self) -> re.Pattern:
        """Splits a text where no piece can reach across: before each mark that follows something else, and around white space that is in no piece."""
        if not self.words_apart:
            return re.compile("(?s).+")
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.pieces))
        return re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else ""))

    def normal(self, text: str) -> str:
        return (MARK if self.dummy_prefix and text else "") + text.replace(MARK, OWN_MARK).replace(" ", MARK)

    def forward(self, text: str, start: int, stop: int, end: int) -> tuple[list[float], list[int]]:
        """Best scores of paths from start to each place up to end, by pieces that start before stop; and where their last piece starts.

        A character that is no piece is a step of its own, at the score of the unknown.
        """
        score, back = [LEAST] * (end + 1), [-1] * (end + 1)
        score[start] = 0.0
        find, longest, unknown = self.pieces.get, self.longest.get, self.unknown
        for at in range(start, stop):
            till = score[at]
            if till == LEAST:
                continue
            first = text[at]
            found = find(first)
            new = till + (unknown if found is None else found[0])
            if new > score[at + 1]:
                score[at + 1], back[at + 1] = new, at
            for to in range(at + 2, min(at + longest(first, 1), end) + 1):
                found = find(text[at:to])
                if found is not None and till + found[0] > score[to]:
                    score[to], back[to] = till + found[0], at
        return score, back

    def ids_between(self, text: str, back: list[int], start: int, end: int) -> list[int]:
        out: list[int] = []
        while end > start:
            piece = self.pieces.get(text[back[end] : end])
            if piece is not None:
                out.append(piece[1])
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[back[end] : end].replace(OWN_MARK, MARK).encode("utf-8", "surrogatepass")))
            end = back[end]
        return out[::-1]

    def best_word(self, word: str) -> bytes:
        """Packed ids of a stretch that no piece reaches into or out of."""
        words, parts = _memos.setdefault(self.signature, ({}, {}))
        found = words.get(word)
        if found is None:
            out, inside, at = [], self.inside, 0
            for k in range(1, len(word) + 1):
                if k < len(word) and word[k - 1 : k + 1] in inside:
                    continue
                part = word[at:k]  # no piece holds the two characters at either end together
                got = parts.get(part)
                if got is None:
                    back = self.forward(part, 0, k - at, k - at)[1]
                    got = np.array(self.ids_between(part, back, 0, k - at), np.int32).tobytes()
                    _remember(parts, part, got)
                out.append(got)
                at = k
            found = b"".join(out)
            _remember(words, word, found)
        return found

    def packed(self, words: list[str]) -> bytes:
        known, best = _memos.setdefault(self.signature, ({}, {}))[0].get, self.best_word
        return b"".join([known(w) or best(w) for w in words])

    @cached_property
    def score_of(self) -> np.ndarray:
        """id -> score; a byte counts as unknown."""
        out = np.full(len(self.spelled), self.unknown)
        for score, k in self.pieces.values():
            out[k] = score
        return out

    @cached_property
    def trie(self) -> Trie:
        return Trie(self)

    def learn_words(self, unseen: list[str]) -> None:
        """Put words in the memo, those in the trie's alphabet by the whole column at once."""
        words, _ = _memos.setdefault(self.signature, ({}, {}))
        if len(words) + len(unseen) > MEMO_WORDS:
            words.clear()
        plain = self.trie.plain
        fit = [w for w in unseen if plain(w)]
        fit.sort(key=len, reverse=True)
        for at in range(0, len(fit), 10_000):
            part = fit[at : at + 10_000]
            words.update(zip(part, self.trie.solve(part), strict=True))

    def learn(self, body: str) -> None:
        self.learn_words(list(set(self.word.findall(body)).difference(_memos.setdefault(self.signature, ({}, {}))[0])))

    def encode_all(self, texts) -> list[np.ndarray]:
        """Ids of whole texts, each in one piece."""
        cut = [self.word.findall(self.normal(t or "")) for t in texts]
        self.learn_words(list({*chain.from_iterable(cut)}.difference(_memos.setdefault(self.signature, ({}, {}))[0])))
        return [np.frombuffer(self.packed(words), np.int32) for words in cut]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, in one piece, word by word."""
        return np.frombuffer(b"".join(map(self.best_word, self.word.findall(self.normal(text or "")))), np.int32).tolist()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.spelled.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
        return raw[1:] if self.dummy_prefix else raw

    def cuts(self, body: str) -> tuple[int, int]:
        """First and last place inside a chunk that no piece reaches across; (0, 0) if there is none."""
        inside, n = self.inside, len(body)
        first = next((k for k in range(1, n) if body[k - 1 : k + 1] not in inside), 0)
        return (first, next(k for k in range(n - 1, 0, -1) if body[k - 1 : k + 1] not in inside)) if first else (0, 0)

    def transfer(self, body: str, ahead: str) -> np.ndarray:
        """(reach, reach) best scores from s characters into the chunk to t characters beyond it."""
        width, n = self.reach, len(body)
        out = np.full((width, width), LEAST)
        text, first, last = body + ahead, *self.cuts(body)
        end = min(n + width - 1, len(text))
        if first == 0:
            for s in range(n + 1, width):  # the piece reaches beyond the whole chunk
                if s - n <= end - n:
                    out[s, s - n] = 0.0
            for s in range(min(width, n + 1)):
                score, _ = self.forward(text, s, n, end)
                out[s, : end - n + 1] = score[n : end + 1]
            return out
        self.learn(body[first:last])
        inner = self.score_of[np.frombuffer(self.packed(self.word.findall(body[first:last])), np.int32)].sum()
        tail, _ = self.forward(text[last:], 0, n - last, end - last)
        for s in range(min(width, first + 1)):
            head, _ = self.forward(body, s, first, first)
            out[s, : end - n + 1] = head[first] + inner + np.array(tail[n - last : end - last + 1])
        return out

    def outline(self, body: str, ahead: str) -> tuple[str, bytes, str, int]:
        """What of a chunk depends on the states at its borders, and the ids of what doesn't.

        (text before the first cut, packed ids of the words between the cuts, text from the last
        cut on with the characters ahead, how many of those are in the chunk). Without a cut, all
        is in the third.
        """
        first, last = self.cuts(body)
        if first == 0:
            return "", b"", body + ahead, len(body)
        words = self.word.findall(body[first:last])
        return body[:first], self.packed(words), (body + ahead)[last:], len(body) - last

    def trace(self, head: str, tail: str, n_tail: int, start: int, stop: int) -> tuple[list[int], list[int]]:
        """Ids of an outlined chunk's pieces before and after the words between its cuts, between given states at its borders."""
        begin, out = start, []
        if head:
            n = len(head)
            out = self.ids_between(head, self.forward(head, start, n, n)[1], start, n)
            begin = 0
        end = n_tail + stop
        return out, self.ids_between(tail, self.forward(tail, begin, n_tail, end)[1], begin, end)

    def backtrace(self, body: str, ahead: str, start: int, stop: int) -> list[int]:
        """Ids of the pieces that start in a chunk."""
        head, inner, tail, n_tail = self.outline(body, ahead)
        before, after = self.trace(head, tail, n_tail, start, stop)
        return [*before, *np.frombuffer(inner, np.int32).tolist(), *after]


def load_model(path: str = MODEL_FILE) -> PieceModel:
    """The vocabulary of a SentencePiece model file; only models that leave texts as they are, byte pieces included, qualify."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("the model changes texts before it cuts them, so they can't be decoded exactly")
    pieces: dict[str, tuple[float, int]] = {}
    spelled: list[bytes] = []
    byte_ids = [-1] * 256
    for k, p in enumerate(proto.pieces):
        spelled.append(p.piece.replace(MARK, " ").encode() if p.type in (1, 4) else b"")
        if p.type in (1, 4):  # normal and user-defined
            pieces[p.piece] = (p.score, k)
        elif p.type == 6:  # a byte, written <0xHH>
            byte_ids[int(p.piece[3:5], 16)] = k
            spelled[k] = bytes([int(p.piece[3:5], 16)])
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces")
    longest: dict[str, int] = {}
    for p in pieces:
        longest[p[0]] = max(longest.get(p[0], 0), len(p))
    return PieceModel(pieces, spelled, byte_ids, spec.add_dummy_prefix, hash((path, len(pieces))), longest)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of stacks of matrices over (max, +)."""
    return (a[:, :, :, None] + b[:, None, :, :]).max(axis=2)


def scan(matrices: np.ndarray) -> np.ndarray:
    """All prefix products of a stack of max-plus matrices, by doubling."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out[step:] = max_plus(out[:-step], out[step:])
        step *= 2
    return out


def border_states(matrices: np.ndarray) -> list[int]:
    """The states of a best path at all borders, the start and the end (0) included."""
    prefix = scan(matrices)[:, 0, :]
    states = [0]
    for k in range(len(matrices) - 1, 0, -1):
        states.append(int(np.argmax(prefix[k - 1] + matrices[k][:, states[-1]])))
    return [0, *states[::-1]]


def chunked(model: PieceModel, text: str, size: int) -> Iterator[tuple[int, str, str]]:
    """(number, body, the characters ahead that pieces may reach into) of the chunks of a whole text."""
    whole = model.normal(text)
    for no, at in enumerate(range(0, len(whole), size)):
        yield no, whole[at : at + size], whole[at + size : at + size + model.reach - 1]


def _escaped(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _plain(raw: bytes) -> str:
    return bytes(raw).decode("utf-8", "surrogatepass")


def packed_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encode_texts(docs: DataFrame, model: PieceModel, chunk: int = CHUNK, check: bool = False) -> DataFrame:
    """(doc_id, text_sha256, ids, round_trip) per row of docs (doc_id, text).

    With check, round_trip says whether the ids decode to the text; else it is null.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary: some MB at most
    file, row = fresh(docs, "_file", "_row")
    rows = numbered(docs, file, row)
    rows = rows.select(column(file).alias("_file"), column(row).alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_sha256", F.sha2("text", 256))
    giant = F.length("text") > chunk

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            for i in range(0, b.num_rows, 400):  # a few texts at a time: the batch itself stays packed
                part = b.slice(i, 400)
                texts = part.column("text").to_pylist()
                ids = m.encode_all(texts)
                right = [m.decode(x) == t for x, t in zip(ids, texts, strict=True)] if check else [None] * len(ids)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "text_sha256": part.column("text_sha256"), "ids": packed_lists(ids), "round_trip": pa.array(right, pa.bool_())})

    out = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("text_sha256 string, ids array<int>, round_trip boolean")])
    small = rows.filter(~giant).drop("_file", "_row").mapInArrow(short, out)
    return small.union(encode_giants(rows.filter(giant), shipped, chunk, check, out))


def encode_giants(rows: DataFrame, shipped: Broadcast, chunk: int, check: bool, out: T.StructType) -> DataFrame:
    """The same for texts of more than one chunk: rows (_file, _row, doc_id, text, text_sha256).

    Chunks are dealt out over all tasks, so one text may use them all. Each gets its matrix and
    its outline by itself; matrices alone meet by text, for the scan; the states at a chunk's borders
    come back to it, and it traces what depends on them. Ids meet by text at the very end.
    """
    doc_id = rows.schema["doc_id"]
    place = ["_file", "_row"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            for i in range(b.num_rows):
                own = b.slice(i, 1)
                parts = list(chunked(m, own.column("text")[0].as_py(), chunk))
                same = {n: pa.concat_arrays([own.column(n)] * len(parts)) for n in (*place, "doc_id", "text_sha256")}
                bodies, aheads = (pa.array([_escaped(p[k]) for p in parts], pa.binary()) for k in (1, 2))
                yield pa.record_batch(same | {"no": pa.array([p[0] for p in parts], pa.int32()), "body": bodies, "ahead": aheads})

    def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            for i in range(0, b.num_rows, 16):
                part = b.slice(i, 16)
                texts = [(_plain(x), _plain(y)) for x, y in zip(part.column("body").to_pylist(), part.column("ahead").to_pylist(), strict=True)]
                matrices = [m.transfer(*t).tobytes() for t in texts]
                head, inner, tail, n_tail = zip(*(m.outline(*t) for t in texts), strict=True)
                yield pa.record_batch({n: part.column(n) for n in (*place, "doc_id", "text_sha256", "no")} | {
                    "matrix": pa.array(matrices, pa.binary()), "head": pa.array(map(_escaped, head), pa.binary()), "inner": pa.array(inner, pa.binary()),
                    "tail": pa.array(map(_escaped, tail), pa.binary()), "n_tail": pa.array(n_tail, pa.int32()),
                })

    def scanned(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """The states at all chunk borders of one text."""
        reach, group = shipped.value.reach, group.sort_values("no")
        at = border_states(np.stack([np.frombuffer(x, float).reshape(reach, reach) for x in group["matrix"]]))
        return pd.DataFrame({"_file": key[0], "_row": key[1], "no": group["no"].to_numpy(), "start": at[:-1], "stop": at[1:]})

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shipped.value
        for b in batches:
            found = [m.trace(_plain(r.head), _plain(r.tail), r.n_tail, r.start, r.stop) for r in b.itertuples()]
            for part in (0, 1):
                yield b[[*place, "no"]].assign(part=2 * part, ids=[np.array(x[part], np.int32).tobytes() for x in found])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            for i in range(b.num_rows):
                own = b.slice(i, 1)
                ids = np.frombuffer(b"".join(own.column("ids")[0].as_py()), np.int32)
                right = hashlib.sha256(m.decode(ids).encode()).hexdigest() == own.column("text_sha256")[0].as_py() if check else None
                yield pa.record_batch({"doc_id": own.column("doc_id"), "text_sha256": own.column("text_sha256"), "ids": packed_lists([ids]), "round_trip": pa.array([right], pa.bool_())})

    named = [*(rows.schema[n] for n in place), doc_id, T.StructField("text_sha256", T.StringType())]
    chunks = rows.mapInArrow(cut, T.StructType([*named, *T.StructType.fromDDL("no int, body binary, ahead binary")])).repartition(*place, "no")
    outlines = written(chunks.mapInArrow(outlined, T.StructType([*named, *T.StructType.fromDDL("no int, matrix binary, head binary, inner binary, tail binary, n_tail int")])))
    states = outlines.select(*place, "no", "matrix").groupBy(*place).applyInPandas(scanned, "_file long, _row long, no int, start int, stop int")
    ends = outlines.select(*place, "no", "head", "tail", "n_tail").join(states, [*place, "no"]).mapInPandas(traced, "_file long, _row long, no int, part int, ids binary")
    none = F.lit(None)
    parts = outlines.select(*place, "no", F.lit(1).alias("part"), F.col("inner").alias("ids"), "doc_id", F.col("text_sha256")).union(
        ends.select("*", none.cast(doc_id.dataType).alias("doc_id"), none.cast("string").alias("text_sha256"))
    )
    ids = F.sort_array(F.collect_list(F.struct("no", "part", "ids")))["ids"].alias("ids")
    whole = parts.groupBy(*place).agg(ids, F.first("doc_id", ignorenulls=True).alias("doc_id"), F.first("text_sha256", ignorenulls=True).alias("text_sha256"))
    return whole.select("doc_id", "text_sha256", "ids").mapInArrow(gathered, out)


def decode_ids(encoded: DataFrame, model: PieceModel, name: str = "decoded") -> DataFrame:
    """encoded with the text that its column ids stands for."""
    shipped = encoded.sparkSession.sparkContext.broadcast(model)
    decoded = F.pandas_udf(lambda ids: pd.Series([shipped.value.decode(x) for x in ids]), "string")
    return encoded.withColumn(name, decoded("ids"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_texts(table(spark, sf_dir, "documents"), load_model(), check=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "text_sha256", "ids")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: doc_id, ids and their number for every row, repeated ones and null ids included; null and empty texts have none."""
    return encode_texts(docs, load_model()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
