"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The merge rule is the library's: of all neighbouring symbols whose joined text
is a piece, the pair of best score is joined first, the leftmost of equals. The
whole of a batch is held as flat numpy arrays:

* The normalised text (dummy prefix, blanks as U+2581) is cut wherever no piece
  contains the two characters at the cut side by side; no merge can span such a
  place, so the parts, here called words, are independent. Equal words are
  encoded once per chunk.
* A round takes each word's smallest pair rank (a segmented minimum), joins its
  pairs of that rank from the left, in all words at once, looks up the new
  neighbour pairs and compacts the arrays; words without a pair leave. A joined
  symbol may form a better pair than an equal pair further right, so a word's
  joins of a round end with the first one that does. A word thus takes about a
  round per distinct rank that occurs in it, however long it is.

Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.llm import flat

BLANK = "▁"
CHUNK_BYTES = 2 << 20
NONE = np.int32(np.iinfo(np.int32).max)


class PieceTable:
    """Pieces, pair ranks and cut places of one BPE model, from its serialized bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        piece = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        self.byte_id = np.zeros(256, np.uint32)
        for i in range(size):
            if sp.is_byte(i):
                self.byte_id[int(piece[i][3:5], 16)] = i
        # Symbols: every ordinary piece, then characters that occur in pieces only.
        symbol = {p: i for i, p in enumerate(piece) if not special[i]}
        for p in list(symbol):
            for c in p:
                symbol.setdefault(c, size + len(symbol))
        self.is_piece_below = size
        chars = [c for c in symbol if len(c) == 1]
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.char_no = np.zeros(0x110000, np.int32)
        for n, c in enumerate(chars, 1):
            self.symbol_of[ord(c)] = symbol[c]
            self.char_no[ord(c)] = n
        self.n_chars = len(chars) + 1
        self.joined = np.zeros(self.n_chars * self.n_chars, bool)
        ordinary = [(p, i) for p, i in symbol.items() if i < size and len(p) > 1]
        scores = sorted({sp.get_score(i) for _, i in ordinary}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        pairs = {}
        for p, i in ordinary:
            no = self.char_no[[ord(c) for c in p]]
            self.joined[no[:-1] * self.n_chars + no[1:]] = True
            for cut in range(1, len(p)):
                left, right = symbol.get(p[:cut]), symbol.get(p[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = (rank_of[sp.get_score(i)], i)
        self._store(pairs)
        text = [b"" if special[i] else piece[i].replace(BLANK, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_id):
            text[i] = bytes([b])
        self.text_off = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in text], out=self.text_off[1:])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.blank_first = np.array([not special[i] and piece[i].startswith(BLANK) for i in range(size)])
        self.is_control = np.array([sp.is_control(i) for i in range(size)])

    def _store(self, pairs: dict) -> None:
        """An open-addressing table of the pairs, probed for whole arrays at once."""
        bits = max(4, (len(pairs) * 8).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        key = np.fromiter(pairs, np.int64, len(pairs))
        self.key = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.into = np.zeros(1 << bits, np.int32)
        at = (flat.mix(key.view(np.uint64)) >> self.shift).astype(np.int64)
        for k, slot, (rank, into) in zip(key.tolist(), at.tolist(), pairs.values()):
            while self.key[slot] != -1:
                slot = (slot + 1) & self.mask
            self.key[slot], self.rank[slot], self.into[slot] = k, rank, into

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined symbol) of symbol pairs; rank NONE where they make no piece."""
        key = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        key[(left < 0) | (right < 0)] = -2
        slot = (flat.mix(key.view(np.uint64)) >> self.shift).astype(np.int64)
        rank, into = np.full(len(key), NONE, np.int32), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.key[slot]
            hit = held == key[todo]
            rank[todo[hit]], into[todo[hit]] = self.rank[slot[hit]], self.into[slot[hit]]
            more = ~hit & (held != -1)
            todo, slot = todo[more], (slot[more] + 1) & self.mask
        return rank, into


def _joinable(table: PieceTable, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, into: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the pairs of smallest rank in their words, those that the rule joins before
    any other pair: from the left without overlap, up to the first one whose joined
    symbol makes a pair of the same or a smaller rank with a neighbour."""
    run = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
    new_word = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
    if new_word.all():
        return at
    several = np.flatnonzero(~(new_word & np.append(new_word[1:], True)))
    x, w, new = at[several], word[at[several]], into[at[several]]
    stop = np.zeros(len(at), bool)
    before = np.where(np.isin(x - 2, at, assume_unique=True), into[np.maximum(x - 2, 0)], sym[np.maximum(x - 1, 0)])
    after = np.minimum(x + 2, len(sym) - 1)
    for left, right, there in ((before, new, (x > 0) & (word[np.maximum(x - 1, 0)] == w)), (new, sym[after], (x + 2 < len(sym)) & (word[after] == w))):
        r = table.look(np.where(there, left, -1).astype(np.int32), right.astype(np.int32))[0]
        stop[several] |= there & (r <= rank[x])
    # A pair stays if no earlier one of its word stops.
    stops = np.cumsum(stop) - stop
    return at[stops == np.repeat(stops[new_word], np.diff(np.append(np.flatnonzero(new_word), len(at))))]


def merge_words(table: PieceTable, sym: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of words after all merges."""
    size = np.diff(off)
    done: dict[str, list] = {"word": [], "sym": []}
    word = np.repeat(np.arange(len(size)), size)
    rank, into = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner], into[inner] = table.look(sym[inner], sym[inner + 1])
    while len(sym):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        least = np.minimum.reduceat(rank, first)
        count = np.diff(np.append(first, len(sym)))
        live = least != NONE
        if not live.all():
            rest = np.repeat(live, count)
            done["sym"].append(sym[~rest])
            done["word"].append(word[~rest])
            sym, word, rank, into = sym[rest], word[rest], rank[rest], into[rest]
            least, count = least[live], count[live]
            if not len(sym):
                break
        at = _joinable(table, sym, word, rank, into, np.flatnonzero(rank == np.repeat(least, count)))
        sym[at] = into[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        sym, word, rank, into = sym[keep], word[keep], rank[keep], into[keep]
        for left in (at - 1, at):
            left = left[(left >= 0) & (left + 1 < len(sym))]
            left = left[word[left] == word[left + 1]]
            rank[left], into[left] = table.look(sym[left], sym[left + 1])
        tail = at[(at + 1 == len(sym)) | (word[np.minimum(at + 1, len(sym) - 1)] != word[at])]
        rank[tail] = NONE
    if not done["sym"]:
        return sym, np.zeros(len(size) + 1, np.int64)
    word, sym = np.concatenate(done["word"]), np.concatenate(done["sym"])
    order = np.argsort(word, kind="stable")
    out = np.zeros(len(size) + 1, np.int64)
    np.cumsum(np.bincount(word, minlength=len(size)), out=out[1:])
    return sym[order], out


def _to_ids(table: PieceTable, sym: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of symbols; a symbol that is no piece becomes the bytes of its character."""
    lone = np.flatnonzero((sym < 0) | (sym >= table.is_piece_below))
    if not len(lone):
        return sym.astype(np.uint32), off
    text = {s: chr(-2 - s) for s in np.unique(sym[lone]).tolist() if s < 0}
    text |= {int(table.symbol_of[c]): chr(c) for c in np.flatnonzero(table.symbol_of >= table.is_piece_below)}
    raw = {s: table.byte_id[list(c.encode())] for s, c in text.items()}
    width = np.ones(len(sym), np.int64)
    width[lone] = [len(raw[s]) for s in sym[lone].tolist()]
    at = np.zeros(len(sym) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    ids = np.repeat(np.where(sym >= 0, sym, 0).astype(np.uint32), width)
    for i in lone:
        ids[at[i] : at[i + 1]] = raw[int(sym[i])]
    return ids, at[off]


def take_runs(values: np.ndarray, off: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs `which` of a flat array laid end to end, and their offsets."""
    size = off[which + 1] - off[which]
    out = np.zeros(len(which) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    at = np.repeat(off[which] - out[:-1], size) + np.arange(out[-1])
    return values[at], out


def encode_chunk(table: PieceTable, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of whole texts, without begin and end ids."""
    code = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    starts = lead[off]
    filled = np.diff(starts) > 0
    # A dummy blank before every text that has any character.
    doc_off = starts + np.concatenate([[0], np.cumsum(filled)])
    flat_code = np.full(doc_off[-1], ord(BLANK), np.uint32)
    own = np.ones(len(flat_code), bool)
    own[doc_off[:-1][filled]] = False
    flat_code[own] = np.where(code == 0x20, ord(BLANK), code)
    n = len(flat_code)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
    no = table.char_no[flat_code]
    cut = np.ones(n + 1, bool)
    cut[1:-1] = ~table.joined[no[:-1] * table.n_chars + no[1:]]
    cut[doc_off] = True
    bound = np.flatnonzero(cut)
    start, end = bound[:-1], bound[1:]
    first, back = flat.equal_segments(flat_code.view(np.uint8), 4 * start, 4 * end)
    sym = table.symbol_of[flat_code]
    sym = np.where(sym < 0, -2 - flat_code.astype(np.int64), sym).astype(np.int32)
    part, part_off = take_runs(sym, bound, first)
    ids, ids_off = _to_ids(table, *merge_words(table, part, part_off))
    out, out_off = take_runs(ids, ids_off, back)
    return out, out_off[np.searchsorted(bound, doc_off)]


def decode_chunk(table: PieceTable, ids: np.ndarray, off: np.ndarray) -> list[str]:
    """Texts of id runs: piece texts joined, blanks restored, the dummy blank
    dropped; bytes that form no character become U+FFFD."""
    raw, at = take_runs(table.text, table.text_off, ids.astype(np.int64))
    begin, end = at[off[:-1]].copy(), at[off[1:]]
    plain = np.flatnonzero(~table.is_control[ids])
    head = np.searchsorted(plain, off[:-1])
    some = head < np.searchsorted(plain, off[1:])
    begin[some] += table.blank_first[ids[plain[head[some]]]]
    raw = raw.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist())]


_TABLES: dict[int, PieceTable] = {}


def _table(model) -> PieceTable:
    key = hash(model.value)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PieceTable(model.value)
    return _TABLES[key]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  begin: bool = True, end: bool = True, packed: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per row of `docs`: id, the columns in `keep`, `n_tokens`, `ids` (array of int, or with
    `packed` little-endian unsigned 32-bit integers in one binary) and `decoded`
    (the text that decoding the ids gives).

    A null or empty text has only the begin and end ids and decodes to the empty
    text; repeated rows and null ids stay as they are; an empty table gives an
    empty result. Columns other than the two named are not read. The model file
    at `model_path` is read by the driver and sent to the tasks (its size is the
    vocabulary's, not the data's).
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    passed = docs.select(id_col, *(keep or []))
    src = docs.select(*passed.columns, F.col(text_col).cast("string").alias("__text"))
    schema = StructType(passed.schema.fields + StructType.fromDDL(f"n_tokens bigint, ids {'binary' if packed else 'array<int>'}, decoded string").fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        table = _table(model)
        for rb in batches:
            for first, raw, off in flat.text_chunks(rb.column(rb.num_columns - 1), CHUNK_BYTES):
                ids, ids_off = encode_chunk(table, raw, off)
                n = len(off) - 1
                at = ids_off + np.arange(n + 1) * (int(begin) + int(end))
                whole = np.empty(at[-1], np.uint32)
                inner = np.ones(len(whole), bool)
                if begin:
                    inner[at[:-1]] = False
                    whole[at[:-1]] = table.bos
                if end:
                    inner[at[1:] - 1] = False
                    whole[at[1:] - 1] = table.eos
                whole[inner] = ids
                if packed:
                    data = whole.astype("<u4").tobytes()
                    col = pa.array([data[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
                else:
                    col = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(whole.astype(np.int32))).cast(arrow.field("ids").type)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, n) for c in rb.columns[:-1]), pa.array(np.diff(at)), col, pa.array(decode_chunk(table, whole, at), pa.string())], schema=arrow)

    return src.mapInArrow(run, schema)
