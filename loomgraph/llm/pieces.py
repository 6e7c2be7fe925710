"""Operator 5, SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A score-ordered agenda holds the adjacent symbol pairs that form a piece of the vocabulary; the best pair is merged
first, ties going to the leftmost, and pairs made stale by an earlier merge are skipped. No piece of a vocabulary that
splits by white space spans a space that follows another character, so a text is a sequence of independent units (a
run of spaces and what follows up to the next space). Units are encoded once and kept in a cache of two generations
of bounded size. In every Arrow batch the units that are new are checked against the sentencepiece library's encoder
and decoded by its decode(ids); should it ever differ, its ids count. A text's ids and its decoded text are those of
its units in order, as each unit begins with its own space.

Defined results: a null or empty text has the end id only and decodes to an empty text; texts of any length are
encoded whole; repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import ship

SPACE = "▁"
UNITS = re.compile(r" ( *[^ ]*)")
CACHE = 500_000
SHORT, ROWS = 30, 8192  # longest unit and most units of one matrix
POS = 5
NO_PAIR = np.int32(1 << 30)
NORMAL, UNKNOWN, BYTE = 1, 2, 6
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Agenda:
    """Encoder for one model file whose normalizer is the identity with a dummy prefix."""

    def __init__(self, model: str):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model, "rb") as f:
            raw = f.read()
        proto.ParseFromString(raw)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces:
            raise ValueError("only merge-type models with an identity normalizer and a dummy prefix are supported")
        self.library = spm.SentencePieceProcessor(model_proto=raw)
        self.ids, self.rank, self.byte_ids = {}, {}, {}
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                self.ids[p.piece], self.rank[p.piece] = i, -p.score
                if SPACE in p.piece.lstrip(SPACE):
                    raise ValueError("a piece spans white space")
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
            elif p.type == UNKNOWN:
                self.unk = i
        self.eos = self.library.eos_id()
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.odd: dict[str, str] = {}  # units that the library decodes to something else
        self.mismatches = 0

    def unit(self, text: str) -> list[int]:
        """Ids of one unit, spaces written as SPACE."""
        sym, rank = list(text), self.rank
        n = len(sym)
        agenda = []
        for i in range(n - 1):
            r = rank.get(sym[i] + sym[i + 1])
            if r is not None:
                agenda.append((r, i, i + 1, 2))
        if agenda:
            heapq.heapify(agenda)
            pop, push = heapq.heappop, heapq.heappush
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            while agenda:
                _, a, b, size = pop(agenda)
                left, right = sym[a], sym[b]
                if not left or not right or len(left) + len(right) != size:
                    continue
                sym[a] = piece = left + right
                sym[b] = ""
                c = after[a] = after[b]
                if c < n:
                    before[c] = a
                    r = rank.get(piece + sym[c])
                    if r is not None:
                        push(agenda, (r, a, c, size + len(sym[c])))
                p = before[a]
                if p >= 0:
                    r = rank.get(sym[p] + piece)
                    if r is not None:
                        push(agenda, (r, p, a, size + len(sym[p])))
        out, ids = [], self.ids
        for s in sym:
            if s:
                i = ids.get(s)
                if i is not None:
                    out.append(i)
                elif self.byte_ids:
                    out += [self.byte_ids[x] for x in s.encode("utf-8")]
                elif not out or out[-1] != self.unk:
                    out.append(self.unk)
        return out

    @staticmethod
    def split(text: str) -> list[str]:
        """Units of a text without their first space."""
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if "  " in text or text[:1] == " ":
            return UNITS.findall(" " + text)
        return text.split(" ") if text else []

    def lockstep(self, units: list[str]) -> list[list[int]]:
        """unit() for many short units at once: each row of a matrix is the agenda of one unit, and in every step the
        best pair of each row is merged. Symbols are numbered; pairs are looked up in an open-addressing table."""
        self._build_pairs()
        lengths = np.array([len(u) for u in units])
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        width = max(2, int(lengths.max()))
        place = np.arange(width)[:, None]
        sym = np.full((len(units), width), -1, np.int32)
        sym[place.T < lengths[:, None]] = self.char_symbol(code)
        sym = np.ascontiguousarray(sym.T)  # position x unit
        best = np.full((width - 1, len(units)), NO_PAIR, np.int32)  # rank << POS | position
        r, c = np.nonzero(sym[1:] >= 0)
        best[r, c] = self.pair(sym[r, c], sym[r + 1, c], r)
        nxt = np.where(place + 1 < lengths, place + 1, width).astype(np.int32)
        prv = np.repeat(place - 1, len(units), axis=1).astype(np.int32)
        low = np.int32((1 << POS) - 1)
        while True:
            top = best.min(axis=0)
            c = np.flatnonzero(top < NO_PAIR)
            if not len(c):
                break
            top = top[c]
            at = top & low
            merged = self.piece_of_rank[top >> POS]
            gone = nxt[at, c]
            follow = nxt[gone, c]
            sym[at, c] = merged
            sym[gone, c] = -1
            nxt[at, c] = follow
            best[np.minimum(gone, width - 2), c] = NO_PAIR
            best[at, c] = NO_PAIR
            has = np.flatnonzero(follow < width)
            h, i, f = c[has], at[has], follow[has]
            prv[f, h] = i
            best[i, h] = self.pair(merged[has], sym[f, h], i)
            before = prv[at, c]
            has = np.flatnonzero(before >= 0)
            h, q = c[has], before[has]
            best[q, h] = self.pair(sym[q, h], merged[has], q)
        sym = np.ascontiguousarray(sym.T)
        keep = sym >= 0
        flat = sym[keep]
        ends = np.cumsum(keep.sum(axis=1)).tolist()
        whole = (flat < self.n_pieces).all()
        flat = flat.tolist()
        out = [flat[x:y] for x, y in zip([0, *ends], ends)]
        if not whole:  # characters outside the vocabulary
            out = [self.unit(u) if max(ids) >= self.n_pieces else ids for u, ids in zip(units, out)]
        return out

    def _build_pairs(self) -> None:
        if hasattr(self, "slots"):
            return
        ids = self.ids
        self.n_pieces = 1 << 17
        chars = {c: i for c, i in ids.items() if len(c) == 1}
        self.char_codes = np.array(sorted(map(ord, chars)), np.uint32)
        self.char_ids = np.array([chars[chr(c)] for c in self.char_codes.tolist()], np.int64)
        ordered = sorted(ids, key=self.rank.get)
        self.piece_of_rank = np.array([ids[p] for p in ordered], np.int64)
        extra: dict[str, int] = {}
        keys, values = [], []
        for k, p in enumerate(ordered):
            for cut in range(1, len(p)):
                pair = []
                for part in (p[:cut], p[cut:]):
                    i = ids.get(part)
                    if i is None and len(part) == 1:
                        i = self.n_pieces + ord(part)
                    pair.append(i)
                if None not in pair:
                    keys.append(pair[0] << 32 | pair[1])
                    values.append(k)
        keys, values = np.array(keys, np.int64), np.array(values, np.int64)
        self.bits = int(np.ceil(np.log2(len(keys) + 1))) + 2
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.found = np.full(1 << self.bits, NO_PAIR, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[todo[free]]  # of several for one slot the last stays
            won = self.slots[at] == keys[todo]
            self.found[at[won]] = values[todo[won]] << POS
            todo, at = todo[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.int64(-7046029254386353131)) >> np.int64(64 - self.bits)) & np.int64((1 << self.bits) - 1)

    def char_symbol(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.char_codes, code), len(self.char_codes) - 1)
        return np.where(self.char_codes[at] == code, self.char_ids[at], self.n_pieces + code.astype(np.int64))

    def pair(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """rank << POS | position of each pair's merged piece, NO_PAIR or more if it is none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        there = self.slots[at]
        out = np.where(there == keys, self.found[at], NO_PAIR)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            there = self.slots[at]
            hit = there == keys[todo]
            out[todo[hit]] = self.found[at[hit]]
            more = ~hit & (there >= 0)
            todo, at = todo[more], at[more]
        return np.where(out < NO_PAIR, out | position, NO_PAIR).astype(np.int32)

    def learn(self, units: set[str]) -> None:
        """Encode new units, check them against the library, and cache them."""
        new = sorted(units, key=len)
        written = [SPACE + u.replace(" ", SPACE) for u in new]
        short = bisect.bisect_right(new, SHORT, key=len)
        own = []
        for a in range(0, short, ROWS):
            own += self.lockstep(written[a : min(a + ROWS, short)])
        own += map(self.unit, written[short:])
        for k, theirs in enumerate(self.library.encode(new, num_threads=1)):
            if new[k] and own[k] != theirs:
                raise ValueError(f"the agenda gives {own[k]} for {new[k]!r}, the library {theirs}")
        for u, back in zip(new, self.library.decode(own, num_threads=1)):
            if u != back:
                self.odd[u] = back
        if len(self.young) + len(new) > CACHE:
            self.old, self.young = self.young, {}
            self.odd = {u: x for u, x in self.odd.items() if u in self.old or u in units}
        self.young.update((u, " ".join(map(str, ids))) for u, ids in zip(new, own))

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """Ids in decimal joined by spaces (without an end id), and the decoded text, of every text."""
        split = [self.split(t) for t in texts]
        words = set(chain.from_iterable(split))
        new = words - self.young.keys()
        if new:
            again = new & self.old.keys()
            kept = {u: self.old[u] for u in again}
            self.learn(new - again)
            kept |= {u: self.old[u] for u in words if u not in self.young and u not in kept}
            self.young |= kept
        ids_of, odd = self.young.__getitem__, self.odd
        return [(" ".join(map(ids_of, u)), " ".join([odd.get(x, x) for x in u] if odd else u)) for u in split]


_agendas: dict[str, Agenda] = {}


def agenda(model: str) -> Agenda:
    if model not in _agendas:
        _agendas[model] = Agenda(model)
    return _agendas[model]


def _chunks(texts: list[str], most: int = 1 << 20):
    """Runs of texts of about `most` characters in total."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode_column(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids array<int> (end id included) and the decoded text of every row."""
    ship(docs.sparkSession)

    def run(batches):
        a = agenda(model)
        for b in batches:
            rows = [r for texts in _chunks([x or "" for x in b.column(1).to_pylist()]) for r in a.encode(texts)]
            ids = [[*map(int, r[0].split()), a.eos] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, decoded string"
    )


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text."""
    ship(docs.sparkSession)

    def run(batches):
        a = agenda(model)
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for b in batches:
            n, x, y = [], [], []
            for texts in _chunks([t or "" for t in b.column(1).to_pylist()]):
                for ids, back in a.encode(texts):
                    ids = f"{ids} {a.eos}" if ids else str(a.eos)
                    n.append(ids.count(" ") + 1)
                    x.append(sha(ids))
                    y.append(sha(back))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(x, pa.string()), pa.array(y, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
