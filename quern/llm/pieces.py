"""SentencePiece encoding and decoding that keeps the original byte span of every piece."""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import map_rows

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Stretches between spaces whose ids each task remembers before it starts anew.
REMEMBERED = 200_000
LONGEST = 40
NONE = 1 << 60


class CharacterMap:
    """Longest-prefix replacement by a compiled character map: a double-array trie over UTF-8 bytes, then the
    replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        self.units: array = array("I")
        self.texts = b""
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = array("I", np.frombuffer(blob[4 : 4 + size], "<u4").tolist())
            self.texts = blob[4 + size :]

    def longest(self, raw: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at ``start``."""
        if not self.units:
            return None
        units, found = self.units, None
        at = self._child(0, units[0])
        for i in range(start, len(raw)):
            at ^= raw[i]
            unit = units[at]
            if unit & 0x800000FF != raw[i]:
                break
            at = self._child(at, unit)
            if unit >> 8 & 1:
                found = i + 1 - start, units[at] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]

    @staticmethod
    def _child(at: int, unit: int) -> int:
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))


class Remembered(dict):
    """The ids, as little-endian bytes, of stretches met before; long ones are merged when met and not kept."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, stretch: str) -> bytes:
        return np.array(self.merge(stretch), "<u4").tobytes()


class PieceModel:
    """A byte-fallback BPE model: normalisation, encoding, spans and decoding."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(blob)
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("a BPE model with white space as prefix is expected")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.bos, self.eos = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.fallback = proto.trainer_spec.byte_fallback
        self.ids, self.scores, self.bytes_of, self.unk = {}, {}, {}, 0
        self.out, self.kind = [], []
        for i, p in enumerate(proto.pieces):
            self.kind.append(p.type)
            if p.type in (NORMAL, USER, UNUSED):
                self.ids[p.piece], self.scores[p.piece] = i, p.score
            if p.type == BYTE:
                self.bytes_of[int(p.piece[3:-1], 16)] = i
            if p.type == UNKNOWN:
                self.unk = i
            self.out.append(self._surface(p, proto.trainer_spec.unk_surface))
        # A space inside a piece would let merges reach over it.
        if any(p.type in (USER, UNUSED) for p in proto.pieces) or any(SPACE in x.lstrip(SPACE) for x in self.ids):
            raise ValueError("user-defined pieces and pieces with a space inside are not supported")
        self.lengths = np.array([len(x.encode()) for x in self.out], np.int64)
        self.lengths[[i for i, k in enumerate(self.kind) if k == CONTROL]] = 0
        order = {x: i for i, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.ranks = {x: order[y] for x, y in self.scores.items()}
        self.known = Remembered(self.merge)
        self.prepare_pairs()
        byte = {i: bytes([b]) for b, i in self.bytes_of.items()}
        table = [byte.get(i, x.encode()) for i, x in enumerate(self.out)]
        self.raw = np.frombuffer(b"".join(table), np.uint8)
        self.raw_lengths = np.array([len(x) for x in table], np.int64)
        self.raw_starts = np.cumsum(self.raw_lengths) - self.raw_lengths
        spaces = [x.count(" ") if k == NORMAL else 0 for x, k in zip(self.out, self.kind, strict=True)]
        self.form_lengths = self.lengths + 2 * np.array(spaces)

    def _surface(self, p, unk: str) -> str:
        if p.type == CONTROL:
            return ""
        return "?" if p.type == BYTE else unk if p.type == UNKNOWN else p.piece.replace(SPACE, " ")

    # normalisation

    def normalize(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normal form, and for each of its bytes and its end the byte of the text that it comes from.

        The second is None where the form is the text itself but for escaped spaces and the prefix.
        """
        if not text:
            return "", None
        if not self.map.units and not self.squeeze and SPACE not in text:
            return (SPACE if self.dummy else "") + text.replace(" ", SPACE), None
        raw = text.encode()
        parts: list[tuple[bytes, int]] = []
        at = 0
        while at < len(raw):
            got = self.map.longest(raw, at)
            if got is None:
                step = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                got = step, raw[at : at + step]
            parts.append((got[1], at))
            at += got[0]
        end = len(raw)
        if self.squeeze:
            while parts and parts[0][0] in (b" ", b""):
                parts.pop(0)
            if not parts:
                return "", np.array([end])
        space = SPACE.encode()
        out, source = bytearray(), []
        if self.dummy:
            out += space
            source += [parts[0][1]] * 3
        after_space = self.squeeze
        for part, start in parts:
            if self.squeeze and after_space:
                part = part.lstrip(b" ")
            for b in part:
                new = space if b == 32 else bytes([b])
                out += new
                source += [start] * len(new)
            if part:
                after_space = self.squeeze and part.endswith(b" ")
        if self.squeeze:
            while out.endswith(space):
                end = source[-3]
                del out[-3:], source[-3:]
        return out.decode(), np.array([*source, end])

    # encoding

    def merge(self, stretch: str) -> list[int]:
        """The ids of a stretch: the best-scored pair of neighbours that is a piece is joined, the leftmost of equals,
        until none is; characters without a piece become bytes."""
        parts: list = list(stretch)
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and (joined := parts[a] + parts[b]) in self.ranks:
                heapq.heappush(heap, (self.ranks[joined], a, b, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or parts[a] + parts[b] != joined or after[a] != b:
                continue
            parts[a], parts[b] = joined, None
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [i for p in parts if p is not None for i in self.plain_ids(p)]

    def plain_ids(self, part: str) -> list[int]:
        if part in self.ids:
            return [self.ids[part]]
        return [self.bytes_of[x] for x in part.encode()] if self.fallback else [self.unk]

    def merge_many(self, stretches: list[str]) -> list[bytes]:
        """As :meth:`merge`, little-endian, for many short stretches of like length at once: a row of symbols each, and
        one merge in every row per round."""
        n, width = len(stretches), max(map(len, stretches)) + 1
        at = np.fromiter(map(len, stretches), np.int64, n)
        codes = np.frombuffer("".join(stretches).encode("utf-32-le"), "<u4")
        chars, where = np.unique(codes, return_inverse=True)
        rows = np.full((n, width), -1, np.int64)
        rows[np.arange(width) < at[:, None]] = np.array([self.symbol(chr(c)) for c in chars])[where]
        out: list = [None] * n
        order = np.arange(n)
        pair = self.pair_at(rows[:, :-1], rows[:, 1:])
        columns = np.arange(width)
        while len(order):
            rank = self.pair_ranks[pair]
            best = rank.argmin(axis=1)
            each = np.arange(len(order))
            done = rank[each, best] == NONE
            if done.any():
                for i, ids in zip(order[done].tolist(), self.rows_bytes(rows[done]), strict=True):
                    out[i] = ids
                go = ~done
                order, rows, pair, best = order[go], rows[go], pair[go], best[go]
                each = each[: len(order)]
            if not len(order):
                break
            rows[each, best] = self.pair_symbols[pair[each, best]]
            rows = np.take_along_axis(rows, np.minimum(columns + (columns > best[:, None]), width - 1), axis=1)
            rows[:, -1] = -1
            pair = np.take_along_axis(pair, np.minimum(columns[:-1] + (columns[:-1] >= best[:, None]), width - 2), axis=1)
            pair[:, -1] = 0
            pair[each, best] = self.pair_at(rows[each, best], rows[each, best + 1])
            left = np.flatnonzero(best > 0)
            pair[left, best[left] - 1] = self.pair_at(rows[left, best[left] - 1], rows[left, best[left]])
        return out

    def rows_bytes(self, rows: np.ndarray) -> list[bytes]:
        """The ids of finished rows, little-endian."""
        real = rows >= 0
        ends = (np.cumsum(real.sum(axis=1)) * 4).tolist()
        flat = rows[real].astype("<u4").tobytes()
        out = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(rows.max(axis=1) >= len(self.kind)):
            out[i] = np.array([x for y in rows[i][real[i]].tolist() for x in self.symbol_ids(y)], "<u4").tobytes()
        return out

    def symbol(self, char: str) -> int:
        """The id of a character's piece, or a number of its own above all ids."""
        got = self.symbols.get(char)
        if got is None:
            got = self.symbols[char] = len(self.kind) + len(self.extra)
            self.extra.append(char)
        return got

    def symbol_ids(self, symbol: int) -> list[int]:
        return [symbol] if symbol < len(self.kind) else self.plain_ids(self.extra[symbol - len(self.kind)])

    def prepare_pairs(self) -> None:
        """A sorted table of the pairs of symbols that join to a piece; entry 0 stands for no pair."""
        self.symbols, self.extra = dict(self.ids), []
        found = []
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if (a in self.ids or cut == 1) and (b in self.ids or len(b) == 1):
                    found.append(((self.symbol(a) << 32) + self.symbol(b), self.ids[piece], rank))
        found.sort()
        self.pair_keys = np.array([-1, *(x[0] for x in found)], np.int64)
        self.pair_symbols = np.array([-1, *(x[1] for x in found)], np.int64)
        self.pair_ranks = np.array([NONE, *(x[2] for x in found)], np.int64)

    def pair_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = np.where((a >= 0) & (b >= 0), (a << 32) + b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, at, 0)

    def learn(self, stretches: set[str]) -> None:
        """Remember the ids of stretches not met before, those of like length together."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = sorted((x for x in stretches if x not in self.known and len(x) <= LONGEST), key=len)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            self.known.update(zip(part, self.merge_many(part), strict=True))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray | None]:
        """All ids with begin and end, and the alignment of :meth:`normalize`."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray | None]]:
        forms = [self.normalize(t or "") for t in texts]
        stretches = [STRETCH.findall(f) for f, _ in forms]
        self.learn(set().union(*stretches))
        out = []
        for (_, source), parts in zip(forms, stretches, strict=True):
            inner = np.frombuffer(b"".join(map(self.known.__getitem__, parts)), "<u4")
            out.append((np.concatenate(([self.bos], inner, [self.eos])).astype("<u4"), source))
        return out

    def spans(self, text: str | None, ids: np.ndarray, source: np.ndarray | None) -> np.ndarray:
        """Begin and end byte of each id in the UTF-8 of the text; bytes of a fallback each have their own."""
        if not text:
            return np.zeros((len(ids), 2), np.int64)
        if source is None:
            ends = np.cumsum(self.lengths[ids])
            if self.dummy:
                ends = np.maximum(ends - 1, 0)
            return np.stack([np.concatenate(([0], ends[:-1])), ends], axis=1)
        ends = np.cumsum(self.form_lengths[ids])
        begin = np.concatenate(([0], ends[:-1]))
        return np.stack([source[begin], source[ends]], axis=1)

    # decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: one leading space, that of the prefix, goes, and bytes that are not UTF-8 become U+FFFD each.

        A control id between two bytes keeps them apart.
        """
        ids = np.asarray(ids)
        size = self.raw_lengths[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.raw_starts[ids] - (ends - size), size)
        raw = self.raw[at + np.arange(len(at))].tobytes()
        drop = raw.startswith(b" ") and (self.dummy or self.squeeze) and self.kind[ids[np.flatnonzero(size)[0]]] == NORMAL
        silent = np.flatnonzero(size[1:-1] == 0) + 1
        borders = [int(drop), *np.maximum(ends[silent], int(drop)).tolist(), len(raw)]
        return "".join(read_utf8(raw[a:b]) for a, b in zip(borders, borders[1:], strict=False))


def read_utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("utf-8", "surrogateescape").translate(NOT_UTF8)


STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NOT_UTF8 = {0xDC00 + b: "�" for b in range(128, 256)}
#: What an encoded document has besides its own columns.
ENCODED = "ids array<int>, spans array<struct<begin:int,end:int>>, decoded string"


def model_blob(path: str) -> bytes:
    """The bytes of a model file, read by the driver alone; they travel with the task, a file of half a megabyte."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """Add ``ids`` (with begin and end), ``spans`` (original UTF-8 bytes of each id) and ``decoded`` to every document.

    Null and empty texts give begin and end alone and decode to the empty text. Equal rows give equal results; an empty
    table stays empty. Column read: ``text``.
    """
    blob = model_blob(model_path)

    def make():
        model = PieceModel(blob)

        def rows(texts):
            coded = model.encode_many(texts)
            spans = [model.spans(t, ids, source) for t, (ids, source) in zip(texts, coded, strict=True)]
            begins = pa.array(np.cumsum([0, *(len(ids) for ids, _ in coded)]), pa.int32())
            flat = np.concatenate([ids for ids, _ in coded]).astype(np.int32)
            begin, end = np.concatenate(spans).astype(np.int32).T
            both = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"])
            decoded = [model.decode(ids) for ids, _ in coded]
            return pa.ListArray.from_arrays(begins, pa.array(flat)), pa.ListArray.from_arrays(begins, both), decoded

        return rows

    return map_rows(docs, ["text"], ENCODED, make, batch=True)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, covered_bytes long"


def digest_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """As :func:`encode_documents`, but with digests in place of arrays.

    ``n_tokens``, ``ids_sha256`` (little-endian unsigned 32-bit ids), ``decoded_sha256`` (UTF-8), ``spans_sha256``
    (begin and end, little-endian unsigned 32-bit) and ``covered_bytes``, the end of the last span.
    """
    blob = model_blob(model_path)

    def make():
        model = PieceModel(blob)

        sha = lambda b: hashlib.sha256(b).hexdigest()

        def row(text, ids, source):
            spans = model.spans(text, ids, source)
            decoded = sha(model.decode(ids).encode())
            return len(ids), sha(ids.tobytes()), decoded, sha(spans.astype("<u4").tobytes()), int(spans[-1, 1])

        def rows(texts):
            return zip(*(row(t, *c) for t, c in zip(texts, model.encode_many(texts), strict=True)), strict=True)

        return rows

    return map_rows(docs, ["text"], DIGESTS, make, batch=True)
