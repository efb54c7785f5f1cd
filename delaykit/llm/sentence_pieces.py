"""SentencePiece ids with the bytes of the text that each piece stands for, and decoding.

A text is first normalised by the model's compiled character map: at each place the longest entry of the
map that matches is replaced, white space becomes the piece mark, and every byte of the result keeps the
place of the text it came from. The normalised text is cut into words, where no piece can cross the cut
(before marks and around line feeds), and each word's characters are merged pair by pair, the pair that makes
the best piece first, as far as pieces go; what is no piece becomes bytes. Words come back often, so the ids
of short ones are kept. Laying the pieces end to end over the normalised text gives their spans, which the
alignment takes back to the original bytes. Models whose pieces are not found by merging pairs, or that
have pieces set by the user, unused pieces or no byte pieces, get their ids from the library.

Everything is worked out within a row; a worker holds the model and at most ``CACHED`` words.

Corner cases: a null text is as an empty one, without ids; texts of any length are encoded whole; equal rows
give equal rows; an empty table gives none; other columns are not read.
"""

import hashlib
import re
import zlib
from heapq import heapify, heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
CACHED = 400_000
LONGEST_CACHED = 48
#: Words of more characters are merged from a queue, others by looking through their pairs.
SHORT = 64
#: Numbers of the model file's format: kinds of pieces and of models.
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5
PAIR_MERGES = 2
WORDS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def message_fields(data: bytes) -> dict[int, list]:
    """Fields of a protocol-buffer message: numbers, or bytes for texts and messages."""
    found: dict[int, list] = {}
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value = data[at : at + size]
            at += size
        found.setdefault(key >> 3, []).append(value)
    return found


class CharacterMap:
    """Longest-prefix lookup in a compiled character map.

    The map is a double-array trie followed by the replacements as NUL-ended texts. A unit of the array
    holds a label, an offset to its children and a flag for a value; the value is the replacement's place.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def replacement(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest entry that ``data`` has at a place, and what stands for it."""
        if not self.units:
            return None
        best = None
        node = self._children(0, self.units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node = self._children(node, unit)
            if unit >> 8 & 1:
                best = (k + 1 - at, self.units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.texts[best[1] : self.texts.index(b"\0", best[1])]

    @staticmethod
    def _children(node: int, unit: int) -> int:
        return node ^ (unit >> 10 << ((unit & 1 << 9) >> 6))


class Normaliser:
    def __init__(self, spec: dict[int, list]):
        flag = lambda number, usual: bool(spec.get(number, [usual])[0])
        self.map = CharacterMap(spec.get(2, [b""])[0])
        self.prefix, self.squeeze, self.marks = flag(3, 1), flag(4, 1), flag(5, 1)

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them, and the end, the place in the text's bytes."""
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        mark = MARK.encode() if self.marks else b" "
        if not self.map.units and not self.squeeze:
            return self._widened(data, mark)
        parts: list[bytes] = []
        places: list[int] = []

        def put(piece: bytes, place: int) -> None:
            parts.append(piece)
            places.extend([place] * len(piece))

        at, spaced = 0, self.squeeze
        pending: list[tuple[bytes, int]] = []
        started = False
        while at < len(data):
            found = self.map.replacement(data, at)
            if found is None:
                first = data[at]
                length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = length, data[at : at + length]
            length, piece = found
            if self.squeeze:
                if spaced:
                    piece = piece.lstrip(b" ")
                if piece:
                    spaced = piece.endswith(b" ")
            for k in range(len(piece)):
                pending.append((piece[k : k + 1], at))
            at += length
        end = len(data)
        while self.squeeze and pending:  # a text ends before the white space that closes it
            last = 1 if pending[-1][0] == b" " else len(mark) if b"".join(b for b, _ in pending[-len(mark) :]) == mark else 0
            if not last:
                break
            end = pending[-last][1]
            del pending[-last:]
        for byte, place in pending:
            if not started and self.prefix:
                put(mark, place)
            started = True
            put(mark if byte == b" " else byte, place)
        return b"".join(parts), np.array([*places, end if pending else 0], np.int64)

    def _widened(self, data: bytes, mark: bytes) -> tuple[bytes, np.ndarray]:
        lead = mark if self.prefix else b""
        width = np.where(np.frombuffer(data, np.uint8) == 0x20, len(mark), 1)
        places = np.repeat(np.arange(len(data)), width)
        return lead + data.replace(b" ", mark), np.concatenate([np.zeros(len(lead), np.int64), places, [len(data)]])


class PieceEncoder:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            fields = message_fields(file.read())
        self.normaliser = Normaliser(message_fields(fields[3][0]))
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        special = [self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i) for i in range(n)]
        self.width = np.array([1 if self.library.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        specs = [message_fields(p) for p in fields[1]]
        kinds = [spec.get(3, [NORMAL])[0] for spec in specs]
        trainer = message_fields(fields[2][0])
        #: Negative score and id of each piece that merging may make.
        self.costs = {
            p: -float(np.frombuffer(spec.get(2, [b"\0" * 4])[0], "<f4")[0]) for p, spec, other in zip(pieces, specs, special) if not other
        }
        self.numbers = {p: i for i, p in enumerate(pieces) if p in self.costs}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.own = (
            trainer.get(3, [1])[0] == PAIR_MERGES
            and bool(trainer.get(35, [0])[0])
            and not trainer.get(24, [0])[0]
            and not {USER_DEFINED, UNUSED} & set(kinds)
        )
        #: Words may be taken alone: marks only lead pieces, and line feeds are bytes.
        self.by_word = all((p.rfind(MARK) <= 0 or not p.strip(MARK)) and "\n" not in p for p in self.costs)
        self.words: dict[str, tuple[int, ...]] = {}

    def merged(self, word: str) -> list[str]:
        """The word's characters, merged pair by pair: the best score first, and of equal ones the leftmost."""
        return self.merged_short(word) if len(word) <= SHORT else self.merged_long(word)

    def merged_short(self, word: str) -> list[str]:
        symbols, cost, none = list(word), self.costs.get, inf
        pairs = [cost(word[k : k + 2], none) for k in range(len(symbols) - 1)]
        while pairs and (best := min(pairs)) != none:
            k = pairs.index(best)
            piece = symbols[k] + symbols.pop(k + 1)
            symbols[k] = piece
            del pairs[k]
            if k < len(pairs):
                pairs[k] = cost(piece + symbols[k + 1], none)
            if k:
                pairs[k - 1] = cost(symbols[k - 1] + piece, none)
        return symbols

    def merged_long(self, word: str) -> list[str]:
        symbols: list[str | None] = list(word)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        costs = self.costs
        queue = [(costs[p], k, k + 1, p) for k in range(n - 1) if (p := word[k : k + 2]) in costs]
        heapify(queue)
        while queue:
            _, left, right, piece = heappop(queue)
            if symbols[left] is None or symbols[right] is None or after[left] != right or len(symbols[left]) + len(symbols[right]) != len(piece):
                continue
            symbols[left], symbols[right] = piece, None
            follows = after[left] = after[right]
            if follows < n:
                before[follows] = left
                if (p := piece + symbols[follows]) in costs:
                    heappush(queue, (costs[p], left, follows, p))
            leads = before[left]
            if leads >= 0 and (p := symbols[leads] + piece) in costs:
                heappush(queue, (costs[p], leads, left, p))
        return [s for s in symbols if s is not None]

    def _word(self, word: str) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in self.merged(word):
            found = self.numbers.get(symbol)
            if found is None:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(found)
        ids = tuple(out)
        if len(word) <= LONGEST_CACHED:
            if len(self.words) >= CACHED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids, and begin and end in bytes of the text of each."""
        normal, places = self.normaliser.normalise(text)
        ids = self._ids(normal) if self.own else self.library.encode(text)
        return ids, self._spans(text, ids, normal, places)

    def _ids(self, normal: bytes) -> list[int]:
        known, out = self.words.get, []
        whole = normal.decode()
        for word in WORDS.findall(whole) if self.by_word else [whole]:
            out += known(word) or self._word(word)
        return out

    def _spans(self, text: str, ids: list[int], normal: bytes, places: np.ndarray) -> np.ndarray:
        ends = np.cumsum(self.width[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)
        if len(ends) and ends[-1] != len(normal):  # an unknown piece stands for a character of any width
            found = self.library.encode(text, return_type="proto").pieces
            return np.array([(p.begin, p.end) for p in found], np.int64).reshape(-1, 2)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return np.stack([places[starts], places[ends]], 1) if len(ends) else np.zeros((0, 2), np.int64)


_loaded: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One per worker."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``ids``, ``begins``, ``ends`` (byte spans in the text) and ``decoded`` of each document."""

    def run(batches):
        pieces = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, spans = zip(*map(pieces.encode, texts)) if texts else ((), ())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([s[:, 0] for s in spans], longs),
                    pa.array([s[:, 1] for s in spans], longs),
                    pa.array([pieces.library.decode(i) for i in ids], pa.string()),
                ],
                names,
            )

    names = [id_col, "ids", "begins", "ends", "decoded"]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, begins array<bigint>, ends array<bigint>, decoded string"
    )


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``spans_crc32`` (of the spans as 64-bit numbers).

    The rows of ``encode``, reduced in the task that makes them.
    """
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"]

    def run(batches):
        pieces = encoder(path)
        numbers = [str(i) for i in range(pieces.library.get_piece_size())]
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                ids, spans = pieces.encode(text)
                out.append((
                    len(ids),
                    hashlib.sha256(",".join([numbers[i] for i in ids]).encode()).hexdigest(),
                    hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest(),
                    zlib.crc32(spans.astype("<i8").tobytes()),
                ))
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"
    )
