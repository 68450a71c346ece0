"""SentencePiece encoding and decoding (operator 1).

Method: the text is normalised by the longest matching prefix of the model's compiled
character map, which records for every normalised byte the source byte it came from; pieces
are merged by score over the normalised text; each piece is projected through that record to
the byte span of the original text it stands for.

Byte-pair models with byte fallback are covered (no user-defined pieces). Where no piece goes on
from letters to other characters or on to a blank, texts are cut there into units; the units
new to a Python worker are merged together in numpy, and kept for up to two generations of
``CACHED`` units.

Defined cases: null and empty texts give no ids and decode to the empty text; very long texts
and very long words are encoded whole; a character without a piece becomes its UTF-8 byte
pieces, of which the last holds the span; repeated rows and null ids are encoded like any
other; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import prepare, read, slices

SPACE = "▁"
CACHED = 150_000  # units in a generation
LONG = 48  # characters up to which units are merged side by side and kept
# fixed values of the model file: piece types
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6

codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes, then the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``text[at:]`` and its replacement."""
        found, units = None, self.units
        node = self._offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class Normalizer:
    def __init__(self, spec, whitespace_as_suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.squeeze, self.dummy = spec.remove_extra_whitespaces, spec.add_dummy_prefix
        self.suffix, self.escape = whitespace_as_suffix, spec.escape_whitespaces

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes (and its end) the offset of the source."""
        source = text.encode()
        if not source:
            return "", np.zeros(1, np.int64)
        if self.map is None and not self.squeeze and self.escape and not self.suffix:
            # no character is mapped: only blanks widen, and the alignment is one vector step
            raw = np.frombuffer(source, np.uint8)
            offset = np.arange(len(raw))
            if len(source) > len(text):  # the bytes of a character stand for its start
                offset = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, offset, 0))
            wide = np.repeat(offset, np.where(raw == 32, 3, 1))
            ahead = np.zeros(3 if self.dummy else 0, np.int64)
            return (SPACE if self.dummy else "") + text.replace(" ", SPACE), np.concatenate([ahead, wide, [len(raw)]])
        return self._mapped(source)

    def _prefix(self, source: bytes, at: int) -> tuple[int, bytes]:
        if self.map is not None and (hit := self.map.longest(source, at)):
            return hit
        lead = source[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, source[at:at + n]

    def _mapped(self, source: bytes) -> tuple[str, np.ndarray]:
        mark = SPACE.encode() if self.escape else b" "
        out, align, at = bytearray(), [], 0
        if self.squeeze:
            while at < len(source):
                n, to = self._prefix(source, at)
                if to != b" ":
                    break
                at += n
            if at == len(source):
                return "", np.full(1, at)
        if self.dummy and not self.suffix:
            out += mark
            align += [at] * len(mark)
        blank = self.squeeze
        while at < len(source):
            n, to = self._prefix(source, at)
            while blank and to.startswith(b" "):
                to = to[1:]
            if to:
                for byte in to:
                    add = mark if byte == 32 else bytes([byte])
                    out += add
                    align += [at] * len(add)
                blank = to.endswith(b" ")
            at += n
            if not self.squeeze:
                blank = False
        end = len(source)
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark):]
                end = align[-len(mark)]
                del align[-len(mark):]
        if self.dummy and self.suffix:
            out += mark
            align += [end] * len(mark)
        return out.decode(), np.array([*align, end], np.int64)


class PairTable:
    """Open-addressed hash table from a pair of symbols to the piece and score it makes."""

    def __init__(self, keys: np.ndarray, to: np.ndarray, score: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.to = np.zeros(1 << self.bits, np.int32)
        self.score = np.full(1 << self.bits, -np.inf)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == -1
            _, first = np.unique(slot[left[free]], return_index=True)
            put = left[free][first]
            self.keys[slot[put]], self.to[slot[put]], self.score[slot[put]] = keys[put], to[put], score[put]
            left = np.setdiff1d(left, put)
            slot[left] = np.where(self.keys[slot[left]] != -1, slot[left] + 1 & (1 << self.bits) - 1, slot[left])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self._slot(keys)
        held = self.keys[slot]
        on = np.flatnonzero((held != keys) & (held != -1))
        flat_slot, flat_keys = slot.reshape(-1), keys.reshape(-1)
        while len(on):
            flat_slot[on] = flat_slot[on] + 1 & (1 << self.bits) - 1
            held = self.keys[flat_slot[on]]
            on = on[(held != flat_keys[on]) & (held != -1)]
        ok = self.keys[slot] == keys
        return np.where(ok, self.score[slot], -np.inf), self.to[slot]


class Codec:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        kinds = [p.type for p in m.pieces]
        if m.trainer_spec.model_type != m.trainer_spec.BPE or not m.trainer_spec.byte_fallback or USER_DEFINED in kinds:
            raise ValueError("a BPE model with byte fallback and without user-defined pieces is needed")
        self.normalizer = Normalizer(m.normalizer_spec, m.trainer_spec.treat_whitespace_as_suffix)
        self.squeeze = m.normalizer_spec.remove_extra_whitespaces
        self.strip = m.normalizer_spec.add_dummy_prefix or self.squeeze
        self.score = {p.piece: p.score for p in m.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        bytes_ = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.byte_ids = [bytes_[b] for b in range(256)]
        self.decimal = [str(i) for i in range(len(kinds))]
        surface = {UNKNOWN: m.trainer_spec.unk_surface, CONTROL: ""}
        self.surface = [surface.get(p.type, p.piece.replace(SPACE, " ")) for p in m.pieces]
        self.raw = [s.encode() for s in self.surface]
        for b, i in bytes_.items():
            self.surface[i], self.raw[i] = chr(b), bytes([b])
        self.high = np.zeros(len(kinds), bool)
        self.high[[bytes_[b] for b in range(128, 256)]] = True
        self.blank = np.array([k in (NORMAL,) and p.piece.startswith(SPACE) for k, p in zip(kinds, m.pieces)])
        self.control = np.array([k == CONTROL for k in kinds])
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        # symbols of the merge: pieces by id, then other characters of pieces, then the unknown
        # character and the padding; and a hash table of the pairs of symbols that make a piece
        symbol = dict(self.ids)
        extra = sorted({c for p in self.ids for c in p} - symbol.keys())
        symbol.update(zip(extra, range(len(kinds), len(kinds) + len(extra))))
        self.unknown = len(kinds) + len(extra)
        self.padding = self.unknown + 1
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.is_piece = np.zeros(self.padding + 1, bool)
        self.is_piece[list(self.ids.values())] = True
        self.width = np.zeros(self.padding + 1, np.uint8)
        for piece, i in symbol.items():
            self.width[i] = len(piece.encode())
        made = [(symbol[p[:k]], symbol[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p))
                if p[:k] in symbol and p[k:] in symbol]
        a, b, to = np.array(made, np.int64).reshape(-1, 3).T
        self.table = PairTable(a * (self.padding + 1) + b, to, np.array([m.pieces[i].score for i in to], np.float64))
        # units: a run of letters (of the pieces) or of other characters, with the blanks before
        # it, where no piece goes on across their borders; else the whole text
        letters = {c for p in self.ids for c in p if unicodedata.category(c)[0] in "LM"}
        crossing = any(p[0] != SPACE and (p[1] == SPACE or (p[0] in letters) != (p[1] in letters)) for p in self.pairs)
        word = re.escape("".join(sorted(letters)))
        self.units = re.compile(".+" if crossing or not letters else
                                f"{SPACE}*[{word}]+|{SPACE}*[^{word}{SPACE}]+|{SPACE}+", re.DOTALL)
        # units met lately and, in two generations, those met before them
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the byte span (begin, end) of the original text under each."""
        return next(self.encode_many([text]))

    def encode_many(self, texts: list[str | None]):
        """``encode`` of each text; the units new to this worker are merged together."""
        normal = [self.normalizer(t or "") for t in texts]
        cut = [self.units.findall(n) for n, _ in normal]
        if len(self.known) > CACHED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {u for units in cut for u in units if u not in known}
        known.update((u, older[u]) for u in new if u in older)
        new = [u for u in new if u not in older]
        known.update(self._merge_many([u for u in new if len(u) <= LONG]))
        long = {u: self._merge_long(u) for u in new if len(u) > LONG}
        for (norm, align), units in zip(normal, cut):
            if not norm:
                yield (np.zeros(0, np.int32),) * 3
                continue
            got = [known[u] for u in units] if not long else [known.get(u) or long[u] for u in units]
            ids = np.frombuffer(b"".join([g[0] for g in got]), np.int32)
            end = np.cumsum(np.frombuffer(b"".join([g[1] for g in got]), np.uint8), dtype=np.int64)
            begin = np.concatenate([[0], end[:-1]])
            yield ids, align[begin].astype(np.int32), align[end].astype(np.int32)

    def _merge_many(self, units: list[str]):
        """(unit, (ids, normalised byte lengths)) of short units, merged side by side: in every
        round each unit merges its pair of highest score, leftmost first."""
        units = sorted(units, key=len)
        for at in range(0, len(units), 4096):
            group = units[at:at + 4096]
            size = np.array([len(u) for u in group])
            s = np.full((len(group), size[-1] + 1), self.padding, np.int32)
            code = np.frombuffer("".join(group).encode("utf-32-le"), "<u4")
            s[np.arange(s.shape[1]) < size[:, None]] = self.of_char[code]
            done = s.copy()
            rows, place = np.arange(len(group)), np.arange(s.shape[1])
            score, to = self._pairs(s[:, :-1], s[:, 1:])
            while len(rows):
                best = score.argmax(axis=1)
                every = np.arange(len(rows))
                live = score[every, best] > -np.inf
                if not live.all():
                    done[rows[~live]] = s[~live]
                    rows, s, score, to, best = rows[live], s[live], score[live], to[live], best[live]
                    every = np.arange(len(rows))
                if not len(rows):
                    break
                made = to[every, best]
                # drop the right half of each merged pair, then look at its new neighbours
                shift = np.minimum(place + (place > best[:, None]), len(place) - 1)
                s = np.take_along_axis(s, shift, axis=1)
                s[every, best] = made
                shift = np.minimum(shift[:, :-1], len(place) - 2)
                score, to = np.take_along_axis(score, shift, axis=1), np.take_along_axis(to, shift, axis=1)
                score[:, -1] = -np.inf
                for k in (np.maximum(best - 1, 0), best):
                    score[every, k], to[every, k] = self._pairs(s[every, k], s[every, k + 1])
            used = done != self.padding
            flat = done[used]
            ids, width = flat.tobytes(), self.width[flat].tobytes()
            end = np.cumsum(used.sum(axis=1)).tolist()
            plain = (self.is_piece[done] | ~used).all(axis=1).tolist()
            for u, i, j, ok in zip(group, [0, *end], end, plain):
                yield u, (ids[4 * i:4 * j], width[i:j]) if ok else self._merge_long(u)

    def _pairs(self, a: np.ndarray, b: np.ndarray):
        return self.table.find(a.astype(np.int64) * (self.padding + 1) + b)

    def _merge_long(self, unit: str) -> tuple[bytes, bytes]:
        """Ids and lengths of one unit, with a heap over a linked list; characters without a
        piece become byte pieces."""
        s = list(unit)
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and (x := self.score.get(both := s[i] + s[j])) is not None:
                heapq.heappush(heap, (-x, i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if not s[i] or (j := after[i]) >= n or s[i] + s[j] != both:
                continue
            s[i], s[j] = both, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        ids, lengths = [], []
        for piece in filter(None, s):
            raw = piece.encode()
            if (i := self.ids.get(piece)) is not None:
                ids.append(i)
                lengths.append(len(raw))
            else:
                ids += [self.byte_ids[b] for b in raw]
                lengths += [0] * (len(raw) - 1) + [len(raw)]
        return array("i", ids).tobytes(), bytes(lengths)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids."""
        if not len(ids):
            return ""
        listed = ids.tolist()
        if not self.high[ids].any():
            text = "".join(map(self.surface.__getitem__, listed))
        else:
            text = b"".join(map(self.raw.__getitem__, listed)).decode("utf-8", "one-by-one")
        first = ids[~self.control[ids]][:1] if self.control[ids[0]] else ids[:1]
        if self.strip and len(first) and self.blank[first[0]]:
            text = text.lstrip(" ") if self.squeeze else text[1:]
        return text


_CODECS: dict[str, Codec] = {}


def codec(model: bytes) -> Codec:
    """This Python worker's codec, kept between tasks."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _narrow(df: DataFrame, id_col: str, col: str, kind: str) -> tuple[DataFrame, str]:
    out = df.select(F.col(id_col).alias("id"), F.col(col).cast(kind).alias(col))
    return out, out.schema["id"].dataType.simpleString()


def _ints(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *lists])))


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, begins, ends) per row: piece ids and their byte spans in the original text."""
    rows, kind = _narrow(docs, id_col, text_col, "string")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                got = list(c.encode_many(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(_ints([g[i] for g in got]) for i in range(3))],
                                                 names=["id", "ids", "begins", "ends"])

    return rows.mapInArrow(run, f"id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(tokens: DataFrame, model: bytes, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) per row of ids; null ids give the empty text."""
    rows, kind = _narrow(tokens, id_col, ids_col, "array<int>")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            texts = [c.decode(np.array(x or [], np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {kind}, text string")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass and return digests: (id, n_tokens, ids_sha256,
    decoded_sha256, spanned_bytes), the last being the bytes of the original under all spans."""
    rows, kind = _narrow(docs, id_col, text_col, "string")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            for part in slices(batch, 1):
                n, ids_sha, text_sha, spanned = [], [], [], []
                for ids, begin, end in c.encode_many(part.column(1).to_pylist()):
                    n.append(len(ids))
                    spanned.append(int((end - begin).sum()))
                    ids_sha.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                     pa.array(text_sha, pa.string()), pa.array(spanned, pa.int64())],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "spanned_bytes"])

    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spanned_bytes long")


def public_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return round_trip(read(spark, sf_dir, "documents"), public_model()).withColumnRenamed("id", "doc_id")
