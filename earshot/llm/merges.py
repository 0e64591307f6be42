"""Byte-pair encoding with a published vocabulary, and decoding.

A piece of text becomes a doubly linked list of symbols; the pairs that have a merge wait
in a priority queue by rank and place; a pair whose symbols have changed since it was put
there is stale and skipped. Decoding concatenates the strings of the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sliced, text_of

# Pieces and words of a generation whose ids a worker remembers, at about 170 bytes each; two generations
# are kept. What is forgotten is encoded again when it comes back.
REMEMBERED = 450_000
# Longer pieces are rarely seen twice.
LONGEST_REMEMBERED = 64
# Bytes of a piece that is merged together with others, and pieces merged together at most.
SHORT, TOGETHER = 24, 1 << 15
# Ids that are put into words at once.
SLICE = 1 << 18


def _byte_letters() -> list[str]:
    """A letter for every byte: itself where it shows as one, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


# The white space of Unicode, as a character class.
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


@lru_cache
def _class_of(category: str, below: int = 0x110000) -> str:
    """All characters of a general category, as ranges for a character class.

    They are those of Python's own database; characters younger than it count as neither
    letters nor numbers.
    """
    points = [c for c in range(below) if unicodedata.category(chr(c))[0] == category]
    starts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -2]) if c + 1 != after]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def _with_classes(pattern: str, below: int) -> str:
    """The pattern for texts of characters below a number; its classes for blanks, letters and numbers stand in brackets."""
    blanks = BLANKS if below > 256 else BLANKS[: BLANKS.index("\\u")]
    pattern = pattern.replace(r"[^\s", f"[^{blanks}")
    for category in "LN":
        pattern = pattern.replace(f"\\p{{{category}}}", _class_of(category, below))
    return pattern


# A letter before a sign that ends words and clauses; a blank between the two leaves most words free of signs.
_SIGN_AFTER, _APART = "([a-z\u00df-\u00f6\u00f8-\u00ff])([,.;:!?])", r"\1 \2"

# Blanks beside and between letters, numbers and other signs.
_MIXED = " a b\tc  's 1 2\n3 !  ?\r\n_ a! \u00e9 \u6f22\u3000\u5b57 1 a ! \n"


class Merges:
    """A vocabulary with ranked merges.

    ``pieces`` cuts normalized text into the parts that are merged on their own, and
    ``word_end`` is what the last symbol of each carries. Strings in ``special`` are ids of
    their own wherever they stand in the raw text.
    """

    def __init__(self, vocab: dict[str, int], merges: list, pieces: str, word_end: str, special: dict[str, int]) -> None:
        self.vocab = vocab
        self.strings = {i: s for s, i in [*vocab.items(), *special.items()]}
        # A pair of ids as one number, and what the merge of a rank makes.
        self.width = 1 + max(vocab.values(), default=0)
        self.ranks, self.made = {}, []
        for rank, (a, b) in enumerate(merges):
            self.ranks[vocab[a] * self.width + vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.decimals = {i: str(i) for i in self.strings}
        # Texts of Latin letters only are cut by a pattern that knows no others, which is quicker.
        self.pieces, self.latin_pieces = (re.compile(_with_classes(pieces, n)) for n in (0x110000, 256))
        # Where no piece has a blank in it, words may be cut on their own.
        self.within_words = not any(c.isspace() for piece in self.pieces.findall(_MIXED) for c in piece)
        # Whether such signs are pieces apart from the letter before them anyway.
        joint = _MIXED + "a, a. ab;c d: \u00e9! e?' 1, f,, g.h i.1 's, 't.a j!? "
        self.signs_apart = self.pieces.findall(joint) == self.pieces.findall(re.sub(_SIGN_AFTER, _APART, joint))
        # A run of letters is one piece if no form that is tried before begins with a letter.
        forms = pieces.split("|")
        before = forms[: forms.index(r"[\p{L}]+")] if r"[\p{L}]+" in forms else ["a"]
        self.letters_whole = not any(f[:1].isalpha() or f[:1] in "[\\(." for f in before)
        self.special = special
        letters = _byte_letters()
        self.byte_ids = [vocab.get(c) for c in letters]
        self.end_ids = [vocab.get(c + word_end) for c in letters]
        # The same merges for many pieces at once: pairs ascending, with their ranks.
        pairs = np.fromiter(self.ranks, np.int64, len(self.ranks))
        ranks = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        by_pair = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[by_pair], ranks[by_pair]
        self.made_ids = np.array(self.made, np.int32)
        longest_first = sorted(special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, longest_first))) if special else None
        self.known = _Known(self)

    def merged(self, symbols: list[int]) -> list[int]:
        """The ids that are left when no two neighbours have a merge, lowest rank first, leftmost of equal ones."""
        ids, n = list(symbols), len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank_of, width = self.ranks.get, self.width
        # A rank and a place in one number, which orders them so.
        queue = []
        for i in range(n - 1):
            rank = rank_of(ids[i] * width + ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] * width + ids[j]) != rank:
                continue  # stale: one of the two has been merged since
            ids[i] = new = self.made[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(new * width + ids[k])
                if rank is not None:
                    heapq.heappush(queue, rank * n + i)
            h = before[i]
            if h >= 0:
                rank = rank_of(ids[h] * width + new)
                if rank is not None:
                    heapq.heappush(queue, rank * n + h)
        return [symbol for symbol in ids if symbol >= 0]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; the number of merges where there is no merge, as beside an id of -1."""
        none, pair = len(self.made), left.astype(np.int64) * self.width + right
        if not none:
            return np.zeros(pair.shape, np.int32)
        at = np.minimum(np.searchsorted(self.pairs, pair), none - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.pair_ranks[at], np.int32(none))

    def merged_together(self, pieces: list[str]) -> list[bytes]:
        """:meth:`of_piece` of many short pieces: each row of a table makes its lowest merge in every round."""
        data = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        row = np.repeat(np.arange(len(data)), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes = np.frombuffer(b"".join(data), np.uint8)
        first, last = (np.array([-1 if i is None else i for i in x], np.int32) for x in (self.byte_ids, self.end_ids))
        ids = np.full((len(data), int(lengths.max()) + 1), -1, np.int32)
        ids[row, column] = np.where(column == lengths[row] - 1, last[codes], first[codes])
        none = len(self.made)
        ranks = self._ranks_of(ids[:, :-1], ids[:, 1:])
        active, left = np.arange(len(data)), lengths.copy()
        while len(active):
            at = ranks[active].argmin(axis=1)
            lowest = ranks[active, at]
            more = lowest < none
            active, at, lowest = active[more], at[more], lowest[more]
            if not len(active):
                break
            # The rest of the row moves up by one place.
            places = np.arange(ids.shape[1] - 1)
            behind = places > at[:, None]
            some, some_ranks = ids[active], ranks[active]
            some[:, :-1] = np.where(behind, some[:, 1:], some[:, :-1])
            some[:, -1] = -1
            some_ranks[:, :-1] = np.where(behind[:, :-1], some_ranks[:, 1:], some_ranks[:, :-1])
            some_ranks[:, -1] = none
            rows = np.arange(len(active))
            some[rows, at] = new = self.made_ids[lowest]
            some_ranks[rows, at] = self._ranks_of(new, some[rows, at + 1])
            has = at > 0
            some_ranks[rows[has], at[has] - 1] = self._ranks_of(some[rows[has], at[has] - 1], new[has])
            ids[active], ranks[active] = some, some_ranks
            left[active] -= 1
        whole = ids[np.arange(ids.shape[1]) < left[:, None]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left)).tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]

    def of_piece(self, piece: str) -> bytes:
        """Ids of a normalized piece, little-endian."""
        data = piece.encode()
        ids = [self.byte_ids[b] for b in data]
        ids[-1] = self.end_ids[data[-1]]
        return np.array(self.merged(ids), "<u4").tobytes()

    def _pieces_of(self, text: str) -> list[str]:
        """The pieces of a normalized text."""
        try:
            text.encode("latin-1")
            pieces = self.latin_pieces
        except UnicodeEncodeError:
            pieces = self.pieces
        return pieces.findall(text)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self._pieces_of(normalized(text))))

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of different normalized words; the short pieces that none before had are merged together."""
        known = self.known
        out = [known.get(w) for w in words]
        found = {w: known.older.get(w) for w, ids in zip(words, out) if ids is None}
        fresh = [w for w, ids in found.items() if ids is None]
        # A word of letters is a piece.
        letters = dict.fromkeys(w for w in fresh if w.isalpha()) if self.letters_whole else {}
        cut = {w: self._pieces_of(w) for w in fresh if w not in letters}
        pieces = {p: known.get(p) or known.older.get(p) for p in set().union(*cut.values())}
        pieces.update(letters)
        new = [p for p, ids in pieces.items() if ids is None]
        # Those of like length share a table.
        short = sorted((p for p in new if len(p) <= SHORT and len(p.encode()) <= SHORT), key=len)
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            pieces.update(zip(some, self.merged_together(some)))
        pieces.update((p, self.of_piece(p)) for p in new if pieces[p] is None)
        found.update((w, pieces[w]) for w in letters)
        found.update((w, b"".join(map(pieces.__getitem__, parts))) for w, parts in cut.items())
        out = [found[w] if ids is None else ids for w, ids in zip(words, out)]
        pieces.update(found)
        kept = {w: ids for w, ids in pieces.items() if len(w) <= LONGEST_REMEMBERED}
        if len(kept) <= REMEMBERED:
            known.learn(kept)
        return out

    def encoded_all(self, texts: list[str]) -> list[np.ndarray]:
        """:meth:`encoded` of each text; each different word of them is looked up once."""
        if not self.within_words:
            return [self.encoded(t) for t in texts]
        plain = [self.special_pattern is None or not any(s in t for s in self.special) for t in texts]
        lines = pa.array([normalized(t) if p else "" for t, p in zip(texts, plain)], pa.large_string())
        if self.signs_apart:
            lines = pc.replace_substring_regex(lines, _SIGN_AFTER, _APART)
        # What other blanks there are stand within a word, and between its pieces.
        words = pc.ascii_split_whitespace(lines)
        coded = words.flatten().dictionary_encode()
        own = self._of_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // 4
        begins = np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy()
        counts = lengths[index]
        ends = np.concatenate(([0], np.cumsum(counts)))
        # Where the ids of each word begin, less the place they go to, and that place again.
        places = np.repeat(begins[index] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(own), "<u4")[places]
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        return [ids[a:b] if p else self.encoded(t) for t, p, a, b in zip(texts, plain, bounds, bounds[1:])]

    def encoded(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return np.frombuffer(self._plain(text), "<u4")
        out, at = [], 0
        for found in self.special_pattern.finditer(text):
            out.append(self._plain(text[at : found.start()]))
            out.append(np.array([self.special[found.group()]], "<u4").tobytes())
            at = found.end()
        out.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(out), "<u4")

    def decoded(self, ids) -> str:
        """The vocabulary's strings, one after the other, a space between them as the format without a decoder has it."""
        return " ".join(map(self.strings.__getitem__, ids))


class _Known(dict):
    """Ids of pieces met lately: two generations, the older forgotten when the younger is full."""

    def __init__(self, merges: Merges) -> None:
        self.merges, self.older = merges, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.merges.of_piece(piece)
            if len(piece) > LONGEST_REMEMBERED:
                return ids
        self.learn([(piece, ids)])
        return ids

    def learn(self, found) -> None:
        """Adds pieces with their ids."""
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self.update(found)


def lowered(text: str) -> str:
    """Lower case letter by letter, whatever stands around a letter."""
    if "Σ" in text:
        return "".join(c.lower() for c in text)
    return text.lower()


def normalized(text: str) -> str:
    """The text as its pieces are cut from; blanks are left as they are."""
    return lowered(unicodedata.normalize("NFC", text))


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """The vocabulary in a tokenizer file with byte letters and word ends; read once per process."""
    with open(path, encoding="utf-8") as f:
        form = json.load(f)
    return from_form(form)


def from_form(form: dict) -> Merges:
    """The vocabulary in the parsed form of a tokenizer file."""
    model, steps = form["model"], form["pre_tokenizer"]["pretokenizers"]
    split = next(s for s in steps if s["type"] == "Split")
    known = [n["type"] for n in form["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
    if model["type"] != "BPE" or not known or form["decoder"] is not None or not split["invert"]:
        raise ValueError("the file is not a lower-casing byte-pair vocabulary with pieces by pattern")
    pieces = split["pattern"]["Regex"]
    special = {t["content"]: t["id"] for t in form["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return Merges(model["vocab"], merges, pieces, model["end_of_word_suffix"] or "", special)


def spoken(merges: Merges, ids: np.ndarray) -> tuple[str, str]:
    """SHA-256 of the decimal ids joined by one space, and of the decoded text."""
    numbers, text = hashlib.sha256(), hashlib.sha256()
    for at in range(0, len(ids), SLICE):
        some = ids[at : at + SLICE].tolist()
        joint = b" " if at else b""
        numbers.update(joint + " ".join(map(merges.decimals.__getitem__, some)).encode())
        text.update(joint + merges.decoded(some).encode())
    return numbers.hexdigest(), text.hexdigest()


def digests(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of whole texts; a missing one is empty.

    ``vocabulary`` is a file that every executor has. Rows are encoded where they lie;
    repeated rows come out repeated, and an empty table gives no rows.
    """

    def run(batches):
        merges = load(vocabulary)
        for batch in sliced(batches):
            counts, numbers, texts = [], [], []
            for text in batch.column(1).to_pylist():
                ids = merges.encoded(text)
                counts.append(len(ids))
                a, b = spoken(merges, ids)
                numbers.append(a)
                texts.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(numbers, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encoded(docs: DataFrame, vocabulary: str, end_id: int | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``ids``, the little-endian unsigned 32-bit ids as binary, with ``end_id`` at the end."""

    def run(batches):
        merges = load(vocabulary)
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        for batch in sliced(batches):
            ids = [merges.encoded(t).tobytes() + end for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary"
    )


def decoded(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``doc_id`` and ``ids`` as :func:`encoded` gives them."""

    def run(batches):
        merges = load(vocabulary)
        for batch in sliced(batches):
            texts = [
                None if ids is None else merges.decoded(np.frombuffer(ids, "<u4").tolist())
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")
