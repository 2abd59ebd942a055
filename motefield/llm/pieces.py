"""Encoding with a merge-type piece vocabulary, and decoding.

A text is encoded without carrying out its merges.  For every prefix of it the encoding has
one last token, whatever follows, and two tokens may stand side by side only if their
characters alone would merge to just these two.  So a table is filled from left to right:
an automaton names the pieces that end at a place, longest first, and the one that is
compatible with the last token of the prefix before it is entered.  Walking back from the
end of the text through the table recovers the ids.  Each place costs a few look-ups, so
time and memory grow with the text's length, whatever it holds.

No piece of the vocabulary has a blank after another character (checked when it is read;
otherwise texts are not cut), so an encoding never crosses from a word into the blanks
before the next, and each word with its blanks is encoded by itself.  Where no piece has a letter beside
another character either, words are cut between these too.  Words met before are
remembered in each Python worker, up to ``REMEMBERED`` of them and ``LONGEST`` characters each.

The rules of the model are those of its file: a blank is put before the text, blanks are
U+2581, characters that are no piece are spelled in byte tokens, texts are not normalised.
A model with other rules is refused.

Defined cases.  Text null or empty: no ids, and decoded to an empty text (null ids: null).
U+2581 in a text counts as a blank, so it is decoded to one.  Very long texts and words are
encoded whole.  Equal rows are encoded apart.  An empty table gives an empty table.  Columns
named ``ids`` and ``decoded`` are replaced; all others are kept.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, widened

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
REMEMBERED = 1 << 18
LONGEST = 64
MOST_PAIRS = 1 << 19
_LETTER, _OTHER = r"[^\W\d_²³¹¼-¾]", r"(?:[^\w ]|[\d_²³¹¼-¾])"
_RUNS = f" *{_LETTER}+| *{_OTHER}+| +"
_BORDER = re.compile(f"{_LETTER}{_OTHER}|{_OTHER}{_LETTER}", re.S)
_NEVER = float("inf")
_PROBE = "ﬁ Á\t x  "          # changed by any usual normalisation


codecs.register_error("each", lambda e: ("\ufffd" * (e.end - e.start), e.end))     # one mark for each byte that is no character


class Vocabulary:
    """Pieces of a model file: text to id and score, the automaton over them, and the bytes of each id."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        usual = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.piece = {model.id_to_piece(i): i for i in usual}
        self.score = {p: model.get_score(i) for p, i in self.piece.items()}
        self.byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        shown = "".join(model.id_to_piece(i) for i in model.encode(_PROBE) if not model.is_byte(i))
        if len(self.byte) < 256 or shown != (BLANK + _PROBE).replace(" ", BLANK).replace("\t", ""):
            raise ValueError("only models that spell in bytes, put a blank before the text and do not normalise")
        self.bytes = [b""] * len(ids)
        for p, i in self.piece.items():
            self.bytes[i] = p.replace(BLANK, " ").encode()
        for b, i in self.byte.items():
            self.bytes[i] = bytes([b])
        for i in ids:
            if model.is_unknown(i):
                self.bytes[i] = " ⁇ ".encode()
        self.leading = {i for p, i in self.piece.items() if p.startswith(BLANK)}
        self.parts = pa.array(self.bytes, pa.binary())
        self.special = np.array([model.is_control(i) for i in ids])
        words_apart = all(BLANK not in p.lstrip(BLANK) for p in self.piece)
        runs_apart = words_apart and not any(_BORDER.search(p.lstrip(BLANK)) for p in self.piece)
        self.words = re.compile(_RUNS if runs_apart else " +[^ ]*" if words_apart else ".+", re.S)
        self.automaton = ahocorasick.Automaton()
        # how each token grows at its right end and at its left end: (part, cost of the merge that takes it up) ..
        self._right: dict[str, list[tuple[str, float]]] = {}
        self._left: dict[str, list[tuple[str, float]]] = {}
        for p in sorted(self.piece, key=len):
            parts, final = self.merged(p)
            if parts != [p]:                     # a piece that its own merges do not reach is never a token
                continue
            self.automaton.add_word(p, (self.piece[p], len(p)))
            if all(len(h) == 1 or h in self._right and -self.score[h] < -self.score[p] for h in final):
                cost = -self.score[p]            # .. where parts are made before the whole, as in every trained piece
                grow = lambda spines, half: [*spines[half][:-1], (half, cost)] if half in spines else [(half, cost)]
                self._right[p] = [*(grow(self._right, final[1]) if len(p) > 1 else []), (p, _NEVER)]
                self._left[p] = [*(grow(self._left, final[0]) if len(p) > 1 else []), (p, _NEVER)]
        self.automaton.make_automaton()
        self.size = len(ids)
        self.token = [model.id_to_piece(i) for i in ids]
        self.number = dict(self.piece)
        self._pairs: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}

    def merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """Tokens of a short text by its merges, best score first, leftmost of equals; and what the last one joined."""
        parts, final = list(text), (text, "")
        while len(parts) > 1:
            at = [(-self.score[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
            if not at:
                break
            k = min(at)[1]
            final = (parts[k], parts[k + 1])
            parts[k:k + 2] = ["".join(final)]
        return parts, final

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens can be neighbours: no merge across the border comes before those that make them, nor after."""
        ends = self._right.get(left) or [(left, _NEVER)] * (len(left) == 1)
        starts = self._left.get(right) or [(right, _NEVER)] * (len(right) == 1)
        if not ends or not starts:
            return self.merged(left + right)[0] == [left, right]
        i = j = 0
        while True:
            (a, take_a), (b, take_b) = ends[i], starts[j]
            score = self.score.get(a + b)
            if score is not None and -score < take_a and -score <= take_b:
                return False
            if take_a == take_b == _NEVER:
                return True
            if take_a <= take_b:
                i += 1
            else:
                j += 1

    def _neighbours(self, pair: int) -> bool:
        if len(self._pairs) >= MOST_PAIRS:
            self._pairs.clear()
        ok = self._pairs[pair] = self.compatible(self.token[pair >> 32], self.token[pair & 0xFFFFFFFF])
        return ok

    def _alone(self, character: str) -> int:
        """The number of a character that is no piece; such characters follow the pieces."""
        if character not in self.number:
            self.number[character] = len(self.token)
            self.token.append(character)
        return self.number[character]

    def tokens(self, word: str) -> list[int]:
        """Numbers of the tokens of a word (blanks as U+2581) by the table of last tokens."""
        last, pairs = [-1] * (len(word) + 1), self._pairs
        for end, (token, size) in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                at = end - size
                if at:
                    left = last[at]
                    if left < 0:                     # no piece ends there: the character stands for itself
                        left = last[at] = self._alone(word[at - 1])
                    pair = left << 32 | token
                    ok = pairs.get(pair)
                    if ok is None:
                        ok = self._neighbours(pair)
                    if ok:
                        last[end] = token
                else:
                    last[end] = token
        out, at = [], len(word)
        while at:
            token = last[at] if last[at] >= 0 else self._alone(word[at - 1])
            out.append(token)
            at -= len(self.token[token])
        return out[::-1]

    def encode(self, word: str) -> bytes:
        """Ids of a word with its blanks, as 32-bit numbers."""
        ids: list[int] = []
        for t in self.tokens(word.replace(" ", BLANK)):
            ids += [t] if t < self.size else [self.byte[b] for b in self.token[t].encode()]
        known = np.array(ids, np.int32).tobytes()
        if len(word) <= LONGEST:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[word] = known
        return known

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a text, as 32-bit numbers: what is remembered of its words is put together without a look at each id."""
        if not text:
            return b""
        known, encode = self._known.get, self.encode
        return b"".join([known(word) or encode(word) for word in self.words.findall(" " + text.replace(BLANK, " "))])

    def encode_text(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once in each Python worker."""
    return Vocabulary(path)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def encode(docs: DataFrame, path: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of ``text``."""
    docs = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in slices(batches, text=text):
            rows = [v.encode_packed(t) for t in batch.column(text).to_pylist()]
            offsets = np.append(0, np.cumsum([len(r) // 4 for r in rows])).astype(np.int32)
            yield _with(batch, "ids", pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32))))

    return docs.mapInArrow(run, widened(docs, "ids array<int>"))


def decoded_texts(ids: pa.ListArray, v: Vocabulary) -> list[str | None]:
    """Texts of lists of ids: control tokens give nothing, and the blank before a text is taken off."""
    flat = pc.list_flatten(ids)
    ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))).astype(np.int32)
    parts = v.parts.take(flat)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), parts), b"").to_pylist()
    flat, out = flat.to_numpy(), []
    control = np.append(0, np.cumsum(v.special[flat]))
    for null, raw, a, b in zip(ids.is_null().to_pylist(), joined, ends[:-1], ends[1:]):
        if control[a] < control[b]:                  # bytes before and after a control token are no character together
            stretches = np.split(flat[a:b], np.flatnonzero(v.special[flat[a:b]]))
            text = "".join(b"".join(v.bytes[i] for i in s).decode(errors="each") for s in stretches)
            first = next((i for i in flat[a:b] if not v.special[i]), -1)
        else:
            text, first = raw.decode(errors="each"), flat[a] if a < b else -1
        out.append(None if null else text[int(first in v.leading):])
    return out


def decode(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``df`` with ``decoded``, the text of the column ``ids``."""
    df = df.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            yield _with(batch, "decoded", pa.array(decoded_texts(batch.column("ids"), v), pa.string()))

    return df.mapInArrow(run, widened(df, "decoded string"))


def codec_digest(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of the ids and of what they decode to."""
    both = decode(encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path).drop("text"), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
