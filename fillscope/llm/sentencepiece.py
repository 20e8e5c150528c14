"""SentencePiece encoding and decoding of BPE models, by backtracking.

A text is cut where no piece can cross: before a run of spaces, and around characters
that no piece holds. Each part is encoded on its own: an Aho-Corasick automaton gives
the pieces that begin at each position; the longest is tried first, and it must
be compatible with the piece before it. Two adjacent pieces are compatible if merging
their joined text again gives just these two. A bitfield marks positions from which
no encoding goes on, so none is tried twice.

Only models whose merges have distinct ranks can be encoded this way; runs of spaces,
whose pieces share one rank in known models, are merged directly.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
# Words after one space and other parts kept with their ids per worker, and the longest part that is kept.
KEPT_WORDS, KEPT_PARTS, KEPT_CHARS = 550_000, 50_000, 32
# A text that a normaliser other than the identity would change.
PROBE = "  ﬁ ①  Ａ　x\tq\n\r é "


class Encoder:
    """Encodes and decodes with one model; equal to the library's encode and decode."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        normal = sentencepiece.SentencePieceNormalizer(model_proto=model)
        if normal.normalize(PROBE) != (SPACE + PROBE).replace(" ", SPACE):
            raise ValueError("the model changes texts before encoding them")
        count = library.get_piece_size()
        self.surface: list[bytes] = [b""] * count
        self.ids: dict[str, int] = {}
        self.byte_ids = [-1] * 256
        for i in range(count):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.ids[piece] = i
                self.surface[i] = piece.replace(SPACE, " ").encode()
        if min(self.byte_ids) < 0:
            raise ValueError("the model has no byte pieces")
        self.rank = {piece: -library.get_score(i) for piece, i in self.ids.items()}
        runs = [p for p in self.ids if p.strip(SPACE) == "" and len(p) > 1]
        words = [p for p in self.ids if p.strip(SPACE)]
        merged = sorted(self.rank[p] for p in words if len(p) > 1)
        if any(SPACE in p[1:] for p in words) or any(a == b for a, b in zip(merged, merged[1:])):
            raise ValueError("the model's pieces cross words or share ranks")
        if runs and merged and min(self.rank[p] for p in runs) <= merged[-1]:
            raise ValueError("the model merges spaces before words")
        self.characters = {c for p in self.ids for c in p}
        # Marks that no piece holds right after a letter: a word can be cut before them.
        after_letter = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        self.marks = "".join(c for c in "\n.,;:!?%&*$#|()[]{}<>=/+\"" if c not in after_letter)
        self.automaton = ahocorasick.Automaton()
        for piece in words:
            self.automaton.add_word(piece, (len(piece), piece))
        self.automaton.add_word(SPACE, (1, SPACE))
        self.automaton.make_automaton()
        self.compatible = lru_cache(maxsize=1 << 17)(self._compatible)
        self.run = lru_cache(maxsize=4096)(self._merge)
        self.cut_lines = "\n" not in self.characters
        # Ids as text: by word, which one space comes before, and by any other part.
        self.words: dict[str, str] = {}
        self.kept: dict[str, str] = {}
        # Whether some part did not decode to itself.
        self.changes = False

    def _merge(self, text: str) -> tuple[str, ...]:
        """Merge characters by rank, the leftmost first among equals."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                joined = parts[i] + parts[after[i]]
                if joined in self.rank:
                    heapq.heappush(heap, (self.rank[joined], i, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j], after[i] = joined, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return tuple(p for p in parts if p is not None)

    def _compatible(self, left: str, right: str) -> bool:
        return self._merge(left + right) == ((left, right) if left else (right,))

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text whose characters all occur in the model."""
        length = len(text)
        starting: list[list[tuple[int, str]]] = [[] for _ in text]
        for last, (size, piece) in self.automaton.iter(text):
            starting[last + 1 - size].append((last + 1, piece))
        failed = bytearray(length // 8 + 1)
        compatible = self.compatible
        found: list[str] = []
        # For each piece taken, and for the place after it, the pieces not yet tried there.
        position, previous, left = 0, "", [len(starting[0])]
        while position < length:
            choices, untried = starting[position], left[-1]
            while untried:
                untried -= 1
                end, piece = choices[untried]
                if not failed[end >> 3] >> (end & 7) & 1 and compatible(previous, piece):
                    left[-1] = untried
                    found.append(piece)
                    position, previous = end, piece
                    left.append(len(starting[end]) if end < length else 0)
                    break
            else:
                if not found:
                    raise ValueError(f"no encoding of {text[:40]!r}")
                failed[position >> 3] |= 1 << (position & 7)
                left.pop()
                position -= len(found.pop())
                previous = found[-1] if found else ""
        return found

    def _segment(self, text: str) -> list[int]:
        """Ids of a part without unknown characters: a run of spaces, then no more spaces."""
        word = text.lstrip(SPACE)
        spaces = len(text) - len(word)
        if not word:
            return [self.ids[p] for p in self.run(text)]
        if not spaces:
            return [self.ids[p] for p in self.pieces(word)]
        found = self.pieces(SPACE + word)
        if found[0] == SPACE:
            found = found[1:]
        else:
            spaces -= 1
        return [self.ids[p] for p in (*self.run(SPACE * spaces), *found)] if spaces else [self.ids[p] for p in found]

    def _part(self, text: str) -> list[int]:
        """Ids of a run of spaces with the characters after it."""
        if self.characters.issuperset(text):
            return self._segment(text)
        ids: list[int] = []
        begin = 0
        for i, c in enumerate(text):
            if c not in self.characters:
                if begin < i:
                    ids += self._segment(text[begin:i])
                ids += [self.byte_ids[b] for b in c.encode()]
                begin = i + 1
        if begin < len(text):
            ids += self._segment(text[begin:])
        return ids

    def _ids(self, part: str) -> str:
        """Ids of a part as text; they are decoded again to see whether they give the part."""
        ids = self._part(part)
        self.changes |= self.decode_bytes(ids) != part.replace(SPACE, " ").encode()
        return ",".join(map(str, ids))

    def _word(self, word: str) -> str:
        """Ids of a word with one space before it."""
        found = self.words.get(word)
        if found is None:
            base = word.rstrip(self.marks)
            if base and base != word and base[-1].isalpha():
                found = f"{self._word(base)},{self._known(word[len(base):])}"
            else:
                found = self._ids(SPACE + word)
            if len(word) <= KEPT_CHARS and len(self.words) < KEPT_WORDS:
                self.words[word] = found
        return found

    def _known(self, part: str) -> str:
        """Ids of any part: marks, lines without a space before them, runs of spaces."""
        found = self.kept.get(part)
        if found is None:
            base = part.rstrip(self.marks)
            if base and base != part and base[-1].isalpha():
                found = f"{self._known(base)},{self._known(part[len(base):])}"
            else:
                found = self._ids(part)
            if len(part) <= KEPT_CHARS and len(self.kept) < KEPT_PARTS:
                self.kept[part] = found
        return found

    def _cut(self, spaces: str, word: str) -> str:
        """Ids of spaces and a word, which may hold line ends."""
        head, *lines = word.split("\n") if self.cut_lines else [word]
        found = [self._known(spaces + SPACE + head) if spaces or not head else self._word(head)]
        for line in lines:
            found.append(self._known("\n"))
            if line:
                found.append(self._known(line))
        return ",".join(found)

    def parts(self, text: str) -> list[str]:
        """Cut a text before each run of spaces and around line ends."""
        marked = (SPACE + text).replace(" ", SPACE)
        found: list[str] = []
        spaces = ""
        for word in marked.split(SPACE)[1:]:
            if not word:
                spaces += SPACE
                continue
            if "\n" in word and "\n" not in self.characters:
                head, *rest = word.split("\n")
                found.append(spaces + SPACE + head)
                for line in rest:
                    found.append("\n")
                    if line:
                        found.append(line)
            else:
                found.append(spaces + SPACE + word)
            spaces = ""
        if spaces:
            found.append(spaces)
        return found

    def encode_text(self, text: str | None) -> tuple[str, int, str]:
        """Comma-joined ids, their number, and the decoded text.

        Every part is decoded when it is first met. As long as each gave itself again, so does the text.
        """
        if not text:
            return "", 0, ""
        plain = text.replace(SPACE, " ")
        get, found, spaces = self.words.get, [], ""
        for word in plain.split(" "):
            if not word:
                spaces += SPACE
            elif spaces:
                found.append(self._cut(spaces, word))
                spaces = ""
            else:
                found.append(get(word) or self._cut("", word))
        if spaces:
            found.append(self._known(spaces))
        joined = ",".join(found)
        return joined, joined.count(",") + 1, self.decode(self.encode(text)) if self.changes else plain

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for a null or empty text."""
        return [i for p in self.parts(text) for i in self._part(p)] if text else []

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.surface[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that marks the beginning."""
        raw = self.decode_bytes(ids)
        if ids and self.surface[ids[0]].startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(model: bytes) -> Encoder:
    """One encoder per worker and model."""
    return Encoder(model)


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and decode the ids again.

    Returns key, ids (array), decoded (string). Rows keep their number: repeated rows and
    null keys give a row each. Null and empty texts have no ids and decode to an empty
    text. Other columns are left out. The model (a file of fixed size) is read once on the
    driver and travels with the task.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                piece = batch.slice(row, 256)
                found = [coder.encode_text(t) for t in piece.column(1).to_pylist()]
                joined = ",".join([k for k, _, _ in found if k])
                ids = pa.array(joined.split(",") if joined else [], pa.string()).cast(pa.int32())
                ends = np.concatenate([[0], np.cumsum([n for _, n, _ in found])]).astype(np.int32)
                yield pa.record_batch(
                    [piece.column(0), pa.ListArray.from_arrays(pa.array(ends), ids), pa.array([d for _, _, d in found], pa.string())],
                    names=["key", "ids", "decoded"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(docs[key], docs[text].cast("string"))
        .mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
        .withColumnRenamed("key", key)
    )


def encode_digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Like ``encode_documents``, with digests instead of ids and texts.

    Returns key, n_tokens, ids_sha256 (of the comma-joined ids), decoded_sha256; rows as there.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                piece = batch.slice(row, 256)
                counts, ids, decoded = [], [], []
                for value in piece.column(1):
                    joined, count, out = coder.encode_text(value.as_py())
                    counts.append(count)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    decoded.append(hashlib.sha256(out.encode()).hexdigest())
                yield pa.record_batch(
                    [piece.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(docs[key], docs[text].cast("string"))
        .mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("key", key)
    )
