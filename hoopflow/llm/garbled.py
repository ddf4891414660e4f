"""Text decoded with the wrong character encoding, found and restored with a hidden Markov model.

States: one for clean text, one for each pair (encoding the bytes were in, encoding they were read as), one for UTF-8 garbled twice,
one for letters that were lost altogether, and one for garbled characters that a clean text cites. A state explains a character by the character its bytes stand for, with the
probability that character has after the one before it (a model of character pairs trained on the corpus itself); the clean state
explains it as it stands. ASCII is the same under all states, so a text is labelled through its other characters; entering and
leaving a state costs. Viterbi's path labels the text, and each labelled span gets its state's inverse transform.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopflow.session import cut

#: Encodings that texts are commonly misread in, and those that texts of these languages are commonly stored in.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp866", "iso8859-2", "iso8859-9", "koi8-r")
STORED = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859-5", "cp866", "koi8-r")
ALSO_READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp866")
PAIRS = tuple(("utf-8", r) for r in READ_AS) + tuple((s, r) for s in STORED for r in ALSO_READ_AS if s != r)
TWICE, LOST = len(PAIRS), len(PAIRS) + 1
CITED = len(PAIRS) + 2
STATES = len(PAIRS) + 3

BUCKETS = 1 << 20
#: What a worker keeps at once: runs in its cache (their length in characters), characters of one Viterbi call, texts in hand.
KEPT, KEPT_CHARS, CELLS, TEXTS = 20_000, 24, 24_000, 1_000
ENTER, LEAVE, SWITCH = -13.0, -1.0, -16.0
#: Citing garbled characters is entered more easily than garbling, and costs a little per character.
ENTER_CITED, CITING = -6.0, -0.5
#: a character that a state can't explain; what a broken sequence costs more than under the clean state
IMPOSSIBLE, BROKEN = -40.0, -2.0
LOSS = "\ufffd"
OPENING, CLOSING = "“‘«„‹\"'(", "”’»“›\"')"
WORD = re.compile(r"[^\W\d_]+")
RUN = re.compile("[^\x00-\x7f]+")


@lru_cache(maxsize=None)
def _bytes_of(codec: str) -> dict[str, int]:
    """The byte of each character of a one-byte encoding; bytes it leaves undefined stand for themselves, as readers commonly have it."""
    table = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table[c] = b
    return table


@lru_cache(maxsize=None)
def _crossed(stored: str, read: str) -> dict[str, str]:
    """Garbled character -> what it was, for two one-byte encodings."""
    back, out = {b: c for c, b in _bytes_of(stored).items()}, {}
    for c, b in _bytes_of(read).items():
        if b in back and back[b] != c and not 0x80 <= ord(back[b]) < 0xA0:
            out[c] = back[b]
    return out


def _need(lead: int) -> int:
    return 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0


def from_utf8(run: str, read: str) -> list[tuple[int, int, str]]:
    """The (start, end, original) of each UTF-8 sequence whose bytes were read with ``read``."""
    table = _bytes_of(read)
    at, found = 0, []
    codes = [table.get(c, -1) for c in run]
    while at < len(run):
        k = _need(codes[at])
        part = codes[at : at + k]
        if k and len(part) == k and all(0x80 <= b < 0xC0 for b in part[1:]):
            try:
                found.append((at, at + k, bytes(part).decode()))
                at += k
                continue
            except UnicodeDecodeError:
                pass
        at += 1
    return found


def _twice(run: str) -> list[tuple[int, int, str]]:
    """UTF-8 misread, saved and misread again, with cp1252 or latin-1 at either time."""
    for second in ("cp1252", "latin-1"):
        outer = from_utf8(run, second)
        middle = "".join(c for _, _, c in outer)
        for first in ("cp1252", "latin-1"):
            inner = from_utf8(middle, first)
            if inner:
                return [(outer[a][0], outer[z - 1][1], c) for a, z, c in inner]
    return []


def readings(run: str) -> list[list[tuple[int, int, str]]]:
    """What each pair, and then double garbling, makes of a run of non-ASCII characters."""
    out = []
    for stored, read in PAIRS:
        if stored == "utf-8":
            out.append(from_utf8(run, read))
        else:
            table = _crossed(stored, read)
            out.append([(i, i + 1, table[c]) for i, c in enumerate(run) if c in table])
    out.append(_twice(run))
    return out


def bucket(first: str, second: str) -> int:
    return (ord(first) * 1000003 + ord(second) * 8191) % BUCKETS


def fold(c: str) -> str:
    """Digits, blanks and ASCII marks are alike as neighbours; letters keep only their case-free form."""
    if c.isalpha():
        return c.lower() if len(c.lower()) == 1 else c
    return "0" if c.isdigit() else " " if ord(c) < 128 else c


def word_bucket(word: str) -> int:
    """Where the words with letters beyond ASCII are counted, behind the character pairs."""
    return BUCKETS + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS


@lru_cache(maxsize=200_000)
def suspicious(run: str) -> bool:
    """A run that is UTF-8 in some encoding for most of its length teaches nothing about clean text."""
    for read in READ_AS:
        covered = sum(z - a for a, z, _ in from_utf8(run, read))
        if covered and (covered * 5 >= len(run) * 3 or read in ("cp1252", "latin-1")):
            return True
    return False


def count_pairs(texts: Iterator[str]) -> dict[int, int]:
    """Counts, by bucket, of the character pairs in which at least one is not ASCII, of single characters (after \\x00) and of words."""
    seen: dict[str, int] = {}
    words: dict[str, int] = {}
    for t in texts:
        for w in WORD.findall(t):
            if not w.isascii():
                words[w] = words.get(w, 0) + 1
        for m in RUN.finditer(t):
            a, z = m.span()
            piece = (t[a - 1] if a else "\n") + t[a:z] + (t[z] if z < len(t) else "\n")
            seen[piece] = seen.get(piece, 0) + 1
    out: dict[int, int] = {}
    for w, n in words.items():
        out[k] = out.get(k := word_bucket(w), 0) + n
    for piece, n in seen.items():
        if suspicious(piece[1:-1]):
            continue
        folded = [fold(c) for c in piece]
        for x, y in zip(folded, folded[1:]):
            out[k] = out.get(k := bucket(x, y), 0) + n
        for y in folded[1:-1]:
            out[k] = out.get(k := bucket("\x00", y), 0) + n
    return out


class Model:
    """Log probabilities of character pairs: a table of fixed size (2 * BUCKETS), so its broadcast is bounded whatever the corpus."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts, self.words = counts[:BUCKETS], counts
        self.total = max(1.0, float(self.counts.sum()) / 3)
        self.kept: dict[str, tuple[np.ndarray, float, np.ndarray]] = {}
        self.pairs: dict[tuple[str, str], float] = {}

    def pair(self, x: str, y: str) -> float:
        """Score of y after x, with x given and the pair smoothed by the single characters."""
        found = self.pairs.get((x, y))
        if found is None:
            if len(self.pairs) >= 5 * KEPT:
                self.pairs.clear()
            found = self.pairs[x, y] = self._pair(x, y)
        return found

    def _pair(self, x: str, y: str) -> float:
        fx, fy = fold(x), fold(y)
        alone = (self.counts[bucket("\x00", fy)] + 0.02) / self.total if ord(y) > 127 else 0.02
        before = self.counts[bucket("\x00", fx)] if ord(x) > 127 else self.total
        score = float(np.log((self.counts[bucket(fx, fy)] + 20.0 * alone) / (before + 20.0)))
        return score - 4.0 if x.islower() and y.isupper() else score

    def attested(self, words: list[str]) -> bool:
        """Whether most of the words with letters beyond ASCII occur in the corpus as they stand; single letters prove nothing."""
        own = [w for w in words if not w.isascii()]
        known = sum(1 for w in own if len(w) > 1 and self.words[word_bucket(w)] >= 2)
        return not own or 2 * known >= len(own)

    def emissions(self, piece: str) -> tuple[np.ndarray, float, np.ndarray]:
        """The scores of a run, the most that any path within it can gain over the clean one, and what each state alone can (kept for
        runs that recur)."""
        found = self.kept.get(piece)
        if found is None:
            e = self._emissions(piece)
            more = np.maximum(e[:, 1:] - e[:, :1], 0.0)
            # Either one state explains the run, or the path pays for changing states within it.
            more[:, CITED] = 0.0
            found = e.astype("float32"), float(max(more.sum(axis=0).max(), more.max(axis=1).sum() + ENTER + LEAVE)), more.sum(axis=0)
            if len(piece) <= KEPT_CHARS:
                if len(self.kept) >= KEPT:
                    self.kept.clear()
                self.kept[piece] = found
        return found

    def _emissions(self, piece: str) -> np.ndarray:
        """The scores [characters, 1 + states] of a run of non-ASCII characters with its two neighbours."""
        before, run, after = piece[0], piece[1:-1], piece[-1]
        n = len(run)
        e = np.full((n, 1 + STATES), IMPOSSIBLE)
        prev = before
        for i, c in enumerate(run):
            e[i, 0] = self.pair(prev, c)
            prev = c
        if ord(after) < 128:
            e[n - 1, 0] += self.pair(prev, after) - np.log(0.02)
        for s, spans in enumerate(readings(run)):
            prev, at = before, 0
            for a, z, c in spans:
                if a > at:
                    prev = run[a - 1]
                e[a:z, 1 + s] = self.pair(prev, c) / (z - a)
                prev, at = c, z
            if at == n and spans and ord(after) < 128:
                e[n - 1, 1 + s] += self.pair(prev, after) - np.log(0.02)
            if s < len(READ_AS) or s == TWICE:  # a broken sequence inside a garbled passage
                known = _bytes_of(PAIRS[s][1] if s < len(READ_AS) else "cp1252")
                for i, c in enumerate(run):
                    if e[i, 1 + s] == IMPOSSIBLE and (c in known or c == LOSS):
                        e[i, 1 + s] = e[i, 0] + BROKEN
        for i, c in enumerate(run):
            if c == LOSS:
                e[i, 0], e[i, 1 + LOST] = -16.0, -1.0
        opened = next((k for k, c in enumerate(piece) if c in OPENING), len(piece))
        closed = next((k for k in range(len(piece) - 1, -1, -1) if piece[k] in CLOSING), -1)
        for i, c in enumerate(run):
            left, right = before if i == 0 else run[i - 1], after if i == n - 1 else run[i + 1]
            # What stands within quotation marks, or a mark of loss by itself, may be spoken of: as garbled as any state has it.
            if opened < i + 1 < closed or c == LOSS and (left.isspace() and right.isspace() or left in OPENING and right in CLOSING):
                e[i, 1 + CITED] = e[i, 1 : 1 + CITED].max() + CITING
        return e


def _pieces(t: str) -> list[tuple[int, int, str]]:
    return [(a, z, (t[a - 1] if a else "\n") + t[a:z] + (t[z] if z < len(t) else "\n")) for a, z in (m.span() for m in RUN.finditer(t))]


def viterbi(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The best label of each character of several texts at once (0: clean). A path may enter, leave or switch states at any character.

    Texts are padded to one length per call, so callers group texts of similar length.
    """
    lengths = np.array([len(b) for b in blocks])
    longest, many, width = int(lengths.max()), len(blocks), blocks[0].shape[1]
    e = np.zeros((longest, many, width), dtype="float32")
    for k, b in enumerate(blocks):
        e[: len(b), k] = b
    enter = np.full(width, ENTER, dtype="float32")
    enter[1 + CITED : 2 + CITED] = ENTER_CITED
    switch = enter + (SWITCH - ENTER)
    score = np.repeat(enter[None, :], many, axis=0)
    score[:, 0] = 0.0
    back = np.zeros((longest, many, width), dtype="int16")
    own = np.arange(width, dtype="int16")[None, :]
    for i in range(longest):
        if i:
            best = score[:, 1:].argmax(axis=1) + 1
            top = np.take_along_axis(score, best[:, None], 1)[:, 0]
            clean, other = score[:, :1] + enter[None, :], top[:, None] + switch[None, :]
            come = np.maximum(clean, other)
            moved = score < come
            back[i] = np.where(moved, np.where(clean >= other, 0, best[:, None]), own)
            new = np.where(moved, come, score)
            home = top + LEAVE > score[:, 0]
            back[i, :, 0] = np.where(home, best, 0)
            new[:, 0] = np.where(home, top + LEAVE, score[:, 0])
            score = np.where((lengths > i)[:, None], new, score)
        live = (lengths > i)[:, None]
        score = np.where(live, score + e[i], score)
        if i:
            back[i] = np.where(live, back[i], own)
    end = score.copy()
    end[:, 1:] += LEAVE
    label = end.argmax(axis=1)
    out = np.zeros((longest, many), dtype="int16")
    for i in range(longest - 1, -1, -1):
        out[i] = label
        label = back[i][np.arange(many), label]
    return [out[: n, k] for k, n in enumerate(lengths)]


def restore(text: str, labels: np.ndarray) -> tuple[str, bool]:
    """The text with each labelled span's inverse transform, and whether all of it could be restored."""
    out, at, k, whole = [], 0, 0, True
    for a, z, _ in _pieces(text):
        out.append(text[at:a])
        run, own = text[a:z], labels[k : k + z - a]
        k += z - a
        i = 0
        while i < len(run):
            j = i
            while j < len(run) and own[j] == own[i]:
                j += 1
            state, part = int(own[i]) - 1, run[i:j]
            if state < 0:
                out.append(part)
            elif state == LOST:
                out.append(part)
                whole = False
            else:
                spans, p = readings(part)[state], 0
                for x, y, c in spans:
                    whole &= x == p
                    out.append(part[p:x] + c)
                    p = y
                whole &= p == len(part)
                out.append(part[p:])
            i = j
        at = z
    return "".join(out) + text[at:], whole


def changed_words(text: str, labels: np.ndarray) -> list[str]:
    """The words of the restored text that contain a restored character."""
    out, k = [], 0
    for a, z, _ in _pieces(text):
        if labels[k : k + z - a].any():
            lo, hi = a, z
            while lo and (text[lo - 1].isalpha() or not text[lo - 1].isascii()):
                lo -= 1
            while hi < len(text) and (text[hi].isalpha() or not text[hi].isascii()):
                hi += 1
            out += WORD.findall(restore(text[lo:hi], _labels_within(text, labels, lo, hi))[0])
        k += z - a
    return out


def _labels_within(text: str, labels: np.ndarray, lo: int, hi: int) -> np.ndarray:
    before = sum(1 for c in text[:lo] if not c.isascii())
    return labels[before : before + sum(1 for c in text[lo:hi] if not c.isascii())]


RESULT = "doc_id long, garbled boolean, restored string, whole boolean, encodings string"


def label_texts(ids: list, texts: list[str], model: Model) -> Iterator[tuple]:
    """doc_id, garbled, restored text, whether it is whole, and the encoding pairs found."""
    for k in range(0, len(ids), TEXTS):
        yield from _label(ids[k : k + TEXTS], texts[k : k + TEXTS], model)


def _may_gain(scores: list[tuple]) -> bool:
    """Whether some path may beat the clean one. A path off the clean state pays for entering and leaving: one that stays in one state gains
    at most what that state does in all runs, one through several states at most the best of each run, and pays twice."""
    most = sum(x[1] for x in scores) + ENTER + LEAVE
    return most > 0 and (most + max(ENTER + LEAVE, SWITCH) > 0 or sum(x[2] for x in scores).max() + ENTER + LEAVE > 0)


def _label(ids: list, texts: list[str], model: Model) -> Iterator[tuple]:
    todo = []
    for i, t in zip(ids, texts):
        pieces = [p for _, _, p in _pieces(t)]
        if pieces and _may_gain([model.emissions(p) for p in pieces]):
            todo.append((i, t, pieces, sum(map(len, pieces)) - 2 * len(pieces)))
        else:
            yield i, False, None, True, ""
    todo.sort(key=lambda x: x[3])
    while todo:
        n = 1
        while n < len(todo) and (n + 1) * todo[n][3] <= CELLS:
            n += 1
        group, todo = todo[:n], todo[n:]
        paths = viterbi([np.concatenate([model.emissions(p)[0] for p in pieces]) for _, _, pieces, _ in group])
        for (i, t, _, _), labels in zip(group, paths):
            labels = np.where(labels == 1 + CITED, 0, labels)
            found = sorted({int(x) - 1 for x in labels if x})
            if found:
                fixed, whole = restore(t, labels)
                if all(len(READ_AS) <= s < TWICE for s in found) and not model.attested(changed_words(t, labels)):
                    found = []
                elif fixed == t and LOST not in found:
                    found = []
            if found:
                names = [("twice" if s == TWICE else "lost" if s == LOST else f"{PAIRS[s][0]} as {PAIRS[s][1]}") for s in found]
                yield i, True, fixed, whole, ", ".join(names)
            else:
                yield i, False, None, True, ""


def train(docs: DataFrame) -> np.ndarray:
    """Counts of character pairs over all texts: at most 2 * BUCKETS rows come to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, int] = {}
        for b in batches:
            for k, n in count_pairs(iter(b["text"])).items():
                total[k] = total.get(k, 0) + n
        yield pd.DataFrame({"k": list(total), "n": list(total.values())}, dtype="int64")

    rows = docs.select("text").where(F.col("text").rlike("[^\\x00-\\x7f]")).mapInPandas(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(2 * BUCKETS, dtype="float64")
    counts[rows["k"].to_numpy("int64")] = rows["n"].to_numpy("float64")
    return counts


#: The model a worker used last, so its tasks share what it has computed.
_LAST: dict[int, Model] = {}


def _apply(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(counts.astype("float32"))
    mark = zlib.crc32(counts.tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if mark not in _LAST:
            _LAST.clear()
            _LAST[mark] = Model(shared.value)
        model = _LAST[mark]
        for b in batches:
            rows = list(label_texts(b["doc_id"].tolist(), b["text"].tolist(), model))
            yield pd.DataFrame(rows, columns=["doc_id", "garbled", "restored", "whole", "encodings"]).astype({"doc_id": "Int64", "garbled": bool, "whole": bool})

    return docs.select("doc_id", "text").where(F.col("text").rlike("[^\\x00-\\x7f]")).mapInPandas(run, RESULT).where("garbled")


def garbled(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """doc_id, restored, whole, encodings of each garbled text.

    Viterbi training: the character model is fitted on all texts but for runs that are UTF-8 misread, then the texts found garbled are
    left out or, where that worked, restored, and it is fitted again. Null, empty, blank and pure ASCII texts are clean. Texts are never shortened. A text that only cites garbled characters
    within quotation marks or alone between blanks is labelled as citing them and stays clean.
    """
    counts = train(docs)
    for _ in range(rounds - 1):
        bad = cut(_apply(docs, counts).select("doc_id", "restored", "whole"))
        clean = docs.select("doc_id", "text").join(bad.select("doc_id"), "doc_id", "left_anti").select("text")
        counts = train(clean.unionByName(bad.where("whole").select(F.col("restored").alias("text"))))
    return _apply(docs, counts).drop("garbled")
