"""Encoding and decoding with a merge-type sentencepiece vocabulary.

Symbols start as single characters. All adjacent pairs whose concatenation is a piece wait in an agenda
ordered by piece score, ties by position; the best pair is merged, its new neighbours join the agenda, and
pairs that have since changed are skipped. Pieces cannot span a word start, and a line feed is
in no piece, so words can be encoded one by one and remembered. Every word that a task encodes
for the first time is checked against the sentencepiece library, a batch of words per call. Where the two differ,
the text gets the library's ids for that word.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain, islice

from pyspark.sql import DataFrame

from growthmill.llm.common import map_texts

SPACE = "▁"
CLOSING = ".,;:!?&%$#*)"
EMPTY = hashlib.sha256(b"").hexdigest()

# Words a task remembers; beyond it the newest half, which is the rarer one, is forgotten.
MEMORY_WORDS = 400_000
# Longer words are not remembered, so that a corpus of unbroken strings cannot fill a task.
REMEMBERED_CHARS = 64

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"


class Words(dict):
    """Coded words by spelling, worked out when a word is first met, and those not yet checked against the library."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec
        self.unchecked: dict[str, list[int]] = {}

    def __missing__(self, word: str) -> tuple[int, str, bytes]:
        coded = self.codec.coded(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= MEMORY_WORDS:
                for old in list(islice(reversed(self), len(self) // 2)):
                    del self[old]
            self[word] = coded
        return coded


class PieceCodec:
    """One vocabulary: agenda encoder, decoder, and the library it is checked against."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.bytes_to_id: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.surfaces: list[bytes] = []
        for i, name in enumerate(names):
            surface = b""
            if self.library.is_byte(i):
                value = int(name[3:5], 16)
                self.bytes_to_id[value] = i
                surface = bytes([value])
            elif self.library.is_unknown(i):
                surface = " ⁇ ".encode()
            elif not self.library.is_control(i):
                self.ids[name] = i
                self.scores[name] = self.library.get_score(i)
                surface = name.replace(SPACE, " ").encode()
            self.surfaces.append(surface)
        self.decimals = [str(i) for i in range(size)]
        self.unknown = self.library.unk_id()
        self.split = self._splitter()
        # The library's ids of words that the agenda encodes otherwise.
        self.wrong: dict[str, list[int]] = {}
        # Characters that stand side by side in some piece; no merge reaches over any other pair.
        self.adjacent = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.memory = Words(self)

    def _splitter(self) -> re.Pattern:
        """Cuts where no piece can reach across."""
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            return re.compile(r"(?s).+")
        if any("\n" in piece for piece in self.ids):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def merge(self, word: str) -> list[int]:
        """Ids of one word, by the agenda of adjacent pairs."""
        symbols: list[str] = list(word)
        count = len(symbols)
        scores = self.scores
        agenda = []
        for i in range(count - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in scores:
                agenda.append((-scores[joined], i, i + 1, joined))
        if agenda:
            heapq.heapify(agenda)
            after = list(range(1, count + 1))
            before = list(range(-1, count - 1))
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            # Stale: one of the symbols has been merged since.
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(joined):
                continue
            symbols[left], symbols[right] = joined, ""
            following, preceding = after[right], before[left]
            after[left] = following
            if following < count:
                before[following] = left
                longer = joined + symbols[following]
                if longer in scores:
                    heapq.heappush(agenda, (-scores[longer], left, following, longer))
            if preceding >= 0:
                longer = symbols[preceding] + joined
                if longer in scores:
                    heapq.heappush(agenda, (-scores[longer], preceding, left, longer))
        out: list[int] = []
        for symbol in symbols:
            if symbol:
                found = self.ids.get(symbol)
                if found is not None:
                    out.append(found)
                elif self.bytes_to_id:
                    out.extend(self.bytes_to_id[b] for b in symbol.encode("utf-8", "replace"))
                else:
                    out.append(self.unknown)
        return out

    def parts(self, word: str) -> tuple[str, str] | None:
        """A word cut before its closing punctuation, where no piece reaches across."""
        stem = word.rstrip(CLOSING)
        if stem and len(stem) < len(word) and (stem[-1], word[len(stem)]) not in self.adjacent:
            return stem, word[len(stem) :]
        return None

    def coded(self, word: str) -> tuple[int, str, bytes]:
        """Number of ids of a word, the ids in decimals, and the bytes they decode to."""
        parts = self.parts(word)
        if parts is not None:
            (n, ids, surface), (n2, ids2, surface2) = self.memory[parts[0]], self.memory[parts[1]]
            return n + n2, f"{ids},{ids2}", surface + surface2
        ids = self.wrong.get(word)
        if ids is None:
            ids = self.merge(word)
            self.memory.unchecked[word] = ids
        return len(ids), ",".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.surfaces.__getitem__, ids))

    def disagreeing(self) -> set[str]:
        """Compare what was encoded since the last call with the library; words that it encodes otherwise.

        What is remembered of such words is forgotten, so that they have the library's ids from now on.
        """
        words, self.memory.unchecked = self.memory.unchecked, {}
        # A line feed before the word keeps the library from putting a space there.
        theirs = self.library.encode(["\n" + w.replace(SPACE, " ") for w in words], num_threads=1)
        found = {w: expected[2:] for (w, ids), expected in zip(words.items(), theirs) if ids != expected[2:]}
        if found:
            self.wrong.update(found)
            self.memory.clear()
        return set(self.wrong)

    def touched(self, words: list[str]) -> bool:
        """Whether a text holds a word that the agenda encodes otherwise than the library."""
        return bool(self.wrong) and not self.wrong.keys().isdisjoint(chain.from_iterable((w, *(self.parts(w) or ())) for w in words))

    def words(self, text: str) -> list[str]:
        """The text as the library normalises it for such a vocabulary, cut into words."""
        return self.split.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def digests(self, words: list[str]) -> tuple[int, str, str]:
        """Number of ids, digest of the ids, digest of the decoded text.

        The decoded text is the surfaces of all pieces without the space put before the text.
        """
        if not words:
            return 0, EMPTY, EMPTY
        counts, decimals, surfaces = zip(*map(self.memory.__getitem__, words))
        decoded = b"".join(surfaces)
        if decoded[:1] == b" ":
            decoded = decoded[1:]
        ids_digest = hashlib.sha256(",".join(decimals).encode()).hexdigest()
        return sum(counts), ids_digest, hashlib.sha256(decoded).hexdigest()

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.merge, self.words(text))))

    def decode(self, ids: list[int]) -> str:
        joined = b"".join(map(self.surfaces.__getitem__, ids))
        return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The vocabulary, loaded once per Python worker."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """Encode and decode every whole text.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256`` and
    ``agrees`` (the agenda gave the library's ids for every word; if not, the row has the library's). A null or empty text has no tokens and
    the digests of nothing; repeated rows give repeated rows; an empty table gives none; other columns are ignored.
    """

    def make():
        model = codec(model_file)

        def apply(doc_ids, texts):
            words = [model.words(t) for t in texts]
            rows = list(map(model.digests, words))
            model.disagreeing()
            wrong = list(map(model.touched, words))
            for i in [i for i, found in enumerate(wrong) if found]:
                rows[i] = model.digests(words[i])
            # Words that the second round encoded anew were checked in the first.
            model.memory.unchecked.clear()
            n_tokens, ids_sha256, decoded_sha256 = zip(*rows)
            return {
                "doc_id": doc_ids,
                "n_tokens": n_tokens,
                "ids_sha256": ids_sha256,
                "decoded_sha256": decoded_sha256,
                "agrees": [not found for found in wrong],
            }

        return apply

    return map_texts(docs, ["doc_id", "text"], make, SCHEMA)
