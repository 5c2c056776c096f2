"""SentencePiece BPE encoding by a table of last tokens, and decoding.

A text is encoded left to right. For every prefix of a chunk the table stores the one token its encoding ends with:
an automaton lists the pieces that end at a position, and a piece is the right one when the token stored at its start
and the piece are compatible, that is when merging the two texts together gives the two tokens back. The ids are read
from the end of the table backwards. No piece of the vocabularies meant here has a blank behind another letter, so a
text falls into independent chunks at blanks; chunks that repeat are looked up in a bounded memo.

The whole model file is read on each executor from ``model_path`` (part of the public tokenizers' package).

Nulls and empty texts give no ids but the end id and decode to "". Very long texts are encoded whole, chunk by chunk (a chunk
without blanks as a whole), in memory in proportion to the text. No two segmentations tie: the model's merges decide. Repeated rows are encoded alike, row by row; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base

BLANK = "▁"  # the model's sign for a blank
CHUNK = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
#: Letters before a sign are a chunk where no piece holds a letter followed by a sign; a line feed where it is no piece.
WORDS = re.compile(f"{BLANK}*[{LETTERS}]+(?=[{SIGNS}{BLANK}\n]|$)|{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
CROSSING = re.compile(f"[{LETTERS}][{SIGNS}]|\n")


class PieceCodec:
    """Encoder and decoder of one BPE model with byte fallback and no normalisation but the leading blank."""

    def __init__(self, model_path: str, memo: int = 800_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.end_id = model.eos_id()
        self.pieces, self.rank, self.ids, self.bytes = [], {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.pieces.append(piece)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError("the model has pieces that cross blanks")
                self.ids[piece], self.rank[piece] = i, -model.get_score(i)
        # Byte pieces decode to themselves below 128 and else to a surrogate that stands for the byte.
        self.plain = [p.replace(BLANK, " ") for p in self.pieces]
        for value, i in self.bytes.items():
            self.plain[i] = chr(value) if value < 128 else chr(0xDC00 + value)
        for i in range(model.get_piece_size()):
            if model.is_control(i):
                self.plain[i] = ""
            elif model.is_unknown(i):
                self.plain[i] = " \u2047 "
        self.chunk = CHUNK if any(CROSSING.search(p) for p in self.ids) else WORDS
        self._learn_splits()
        self.fits = base.Remembered(lambda key: self._compatible((self.pieces[key >> 20], self.pieces[key & 0xFFFFF])), 1_000_000)
        self.chunks = base.Remembered(self._chunk, memo)

    def _learn_splits(self) -> None:
        """For each piece the pair it is merged from last, and the automaton over the pieces that merging can reach."""
        alike: dict[float, list[str]] = {}
        for piece, rank in self.rank.items():
            if len(piece) > 1:
                alike.setdefault(rank, []).append(piece)
        #: Pieces of equal score merge in an order that hangs on the place, so they have no unique last tokens.
        tied = {p for same in alike.values() if len(same) > 1 for p in same}
        self.split: dict[str, tuple[str, str] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.ids, key=lambda p: (len(p) > 1, self.rank[p])):
            if piece in tied:
                continue
            if len(piece) == 1:
                self.split[piece] = None
            else:
                pairs = ((piece[:k], piece[k:]) for k in range(1, len(piece)))
                found = next((p for p in pairs if p[0] in self.split and p[1] in self.split and self._compatible(p, piece)), None)
                if found is None:
                    continue
                self.split[piece] = found
            self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """Symbols after all merges, best score first, leftmost first among equals."""
        symbols, n = list(text), len(text)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (rank := self.rank.get(pair := symbols[left] + symbols[right])) is not None:
                heapq.heappush(queue, (rank, left, right, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, pair = heapq.heappop(queue)
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [s for s in symbols if s]

    def _compatible(self, pair: tuple[str, str], but: str = "") -> bool:
        """Whether merging the joint text of two pieces ends in these two (or, with ``but``, in that piece by a last merge).

        Walks back through the merges on both sides, the latest first. The pieces stay apart if at no time the two
        symbols at the border could merge before the next merge that takes one of them away.
        """
        left, right = pair
        rank, split = self.rank, self.split
        # The rank at which the symbol at the border goes into the next one; the left one wins against equals.
        left_goes = right_goes = float("inf")
        while True:
            crossing = rank.get(left + right)
            if crossing is not None and left + right != but and crossing < left_goes and crossing <= right_goes:
                return False
            one, other = split[left], split[right]
            if one is None and other is None:
                return True
            # Undo the later of the two merges; of equal ones that is the right one.
            if other is None or one is not None and rank[left] > rank[right]:
                left_goes, left = rank[left], one[1]
            else:
                right_goes, right = rank[right], other[0]

    def _tokens(self, text: str) -> list[int] | None:
        """Ids of a chunk from its table of last tokens, None where the table finds none."""
        n, fits = len(text), self.fits
        last, width = [0] * (n + 1), [0] * (n + 1)
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if not width[end]:
                start = end - size
                if not start or width[start] and fits[last[start] << 20 | token]:
                    last[end], width[end] = token, size
        out = []
        while n:
            if not width[n]:
                return None
            out.append(last[n])
            n -= width[n]
        out.reverse()
        return out

    def _chunk(self, text: str) -> tuple[int, ...]:
        if not text.startswith(BLANK * 2) and (whole := self._tokens(text)) is not None:
            return tuple(whole)
        # Characters the vocabulary lacks never merge: each is a break, written as bytes.
        out: list[int] = []
        at, n = 0, len(text)
        while at < n:
            end = at
            while end < n and text[end] in self.ids:
                end += 1
            if end > at:
                part = text[at:end]
                tokens = None if part.startswith(BLANK * 2) else self._tokens(part)
                out += [self.ids[t] for t in self.merged(part)] if tokens is None else tokens
            if end < n:
                out += [self.bytes[b] for b in text[end].encode()]
            at = end + 1
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text with the end id."""
        out: list[int] = []
        if text:
            found = self.chunk.findall(BLANK + text.replace(" ", BLANK))
            if max(map(len, found)) <= 64:
                out.extend(chain.from_iterable(map(self.chunks.__getitem__, found)))
            else:  # very long chunks are not kept
                for chunk in found:
                    out += self.chunks[chunk] if len(chunk) <= 64 else self._chunk(chunk)
        out.append(self.end_id)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids have none, and one leading blank belongs to the model."""
        plain = self.plain
        text = "".join([plain[i] for i in ids])
        led = text.startswith(" ") and self.pieces[next(i for i in ids if plain[i])].startswith(BLANK)
        try:
            text.encode()
        except UnicodeEncodeError:
            parts: list[list[str]] = [[]]
            for i in ids:  # an id without text ends a character written as bytes
                parts.append([]) if plain[i] == "" else parts[-1].append(plain[i])
            text = "".join(_text("".join(p).encode("utf-8", "surrogateescape")) for p in parts)
        return text[1:] if led else text


def _text(run: bytes) -> str:
    """Byte pieces as text; a byte that is no part of a character becomes the replacement sign."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for width in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + width].decode())
                    at += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def codec(model_path: str) -> PieceCodec:
    """One codec for each Python worker, as long as its tasks ask for this model."""
    return base.worker_state(("codec", model_path), lambda: PieceCodec(model_path))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the ids of every whole text with the end id."""

    def body(batch):
        own = codec(model_path)
        ids = pa.array([own.encode(x) for x in base.texts(batch)], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return base.map_batches(base.keyed_text(docs, id_col, text_col), body, "doc_id long, ids array<int>", ("codec", model_path))


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the texts of arrays of ids (null: empty)."""

    def body(batch):
        own = codec(model_path)
        out = pa.array([own.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), out], ["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return base.map_batches(narrow, body, "doc_id long, text string", ("codec", model_path))


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded: encoding and decoding in one pass over the texts."""

    def body(batch):
        own = codec(model_path)
        ids = [own.encode(x) for x in base.texts(batch)]
        columns = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(x) for x in ids], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return base.map_batches(base.keyed_text(docs, id_col, text_col), body, "doc_id long, ids array<int>, decoded string", ("codec", model_path))


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    return round_trip(docs, model_path, id_col, text_col).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
