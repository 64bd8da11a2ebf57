"""Toxicity of texts that may hide their words: a noisy channel undone by Viterbi, then a score of the restored words.

A token that is not plain letters, one with a letter twice in a row or with signs at its edges that can stand for
letters, and single letters in a row are read as a lattice: each character stands for some letters at a cost (leetspeak),
for nothing (a separator), or for a parting of words, a mask after a letter or before the first one for any of a to z,
other masks for vowels, and a run of one letter for one or two of it. The cheapest path under a character trigram model
gives the restored words, at a cost that grows with the token's length, which may be any. Words joined by punctuation are
restored one by one, and neighbouring short ones (SHORT letters at most) are read as pieces of one word too. A token of letters whose lattice has one path is taken as it is; if it has more, the word between the signs is another
reading, and so is the word with the sign before or after it read as a letter; a score takes the worst of them. Three or more
single characters in a row, with any white space between, are one lattice, however long the row. So are two or more tokens in
a row of SHORT characters at most that together can spell a toxic word. A lattice may keep a gap as a parting of words, at
a cost, or drop it. The trigrams are counted over the words of all documents, in cased letters only, which bounds the
model by the alphabets.

The score is a logistic regression on how many words of a text are toxic, by how much, and what share. Words and word beginnings
are toxic by log odds of their document frequencies in labelled documents: those whose log odds are
LEAST_ODDS or more, and SURE_ODDS or more at the lower end of their confidence interval, which asks the same of any number of
labels. Labelled texts that agree in the least hash of their 5-word shingles, as near copies mostly do, count once in this, as
copies would else make any of their rare words look sure. In learning, a token of letters counts as it stands. Tokens none of
whose paths can spell such a part have weight 0, and are not decoded to find that out. It is fitted on at most FIT_TOXIC + FIT_CLEAN labelled rows, chosen by a hash of their ids, of those whose crc32(doc_id as text) mod 5 is
not 0. Neither ids, labels, languages nor sources are inputs of a score.

Null and empty texts get the score of a text without toxic words. A null id is not held out and not learned from. Of
several labels of an id the largest counts; null labels are none. Without toxic labels scores are 0, without clean
ones 1. Repeated rows are scored one by one. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import cut, kept_by, pick, utf8

#: Labelled rows that the classifier is fitted on, at most.
FIT_TOXIC, FIT_CLEAN = 5000, 15000
HELD_OUT_OF = 5
#: Log odds of a toxic word, at least, as counted and so many standard errors below.
LEAST_ODDS, SURE_ODDS, ERRORS_BELOW = 2.0, 1.0, 2.33
PREFIXES = (4, 5, 6)
#: Tokens that a worker remembers; it forgets all when it has so many.
REMEMBERED = 150_000

#: What a character can stand for, and the cost. The empty text leaves it out; a space parts two words.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
#: Letters drawn with several characters.
DRAWN = {"|-|": "h", "|_|": "u", "|<": "k", "|)": "d", "|3": "b", "|2": "r", "()": "o", "\\/\\/": "w", "\\/": "v"}
LEET_COST, DROP_COST, DROP_DIGIT_COST, PART_COST, MASK_COST, RUN_COST = 0.7, 0.5, 8.0, 4.0, 3.0, 0.3
#: Characters of a piece of a word, at most.
SHORT = 4
MASKS, VOWELS, LETTERS = "*#", "aeiou", "abcdefghijklmnopqrstuvwxyz"
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…|*%&#~^`=-_/\\"

_RUN = re.compile(r"(.)\1\1")
_READ = re.compile(rf"([^\W\d_])\1|[{re.escape(''.join(LEET) + MASKS)}]")
_MASKED = re.compile(rf"([{MASKS}]?)[^\W\d_]+([{MASKS}]?)")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_PIECES = re.compile(rf"(?<!\S)\S{{1,{SHORT}}}(?:\s+\S{{1,{SHORT}}})+(?!\S)")
_NOISE = re.compile(r"([^\w\s])\1")
_PARTS = re.compile(r"[.,;:/_|&+=<>()\[\]\"'’-]+")


class Model:
    """Character trigrams with smoothing by shorter ones. ``^`` stands before a word twice, ``$`` ends it."""

    def __init__(self, counts: dict[str, int]):
        self.three, self.two, self.one = counts, Counter(), Counter()
        self.seen_two, self.seen_one, self.total = Counter(), Counter(), 0
        for gram, n in counts.items():
            self.two[gram[1:]] += n
            self.one[gram[2]] += n
            self.seen_two[gram[:2]] += n
            self.seen_one[gram[1]] += n
            self.total += n
        self.known: dict[str, float] = {}

    def cost(self, before: str, letter: str) -> float:
        """-log P(letter | two letters before)."""
        gram = before + letter
        found = self.known.get(gram)
        if found is None:
            p1 = (self.one[letter] + 0.1) / (self.total + 10)
            p2 = (self.two[before[1] + letter] + 5 * p1) / (self.seen_one[before[1]] + 5)
            found = self.known[gram] = -math.log((self.three.get(gram, 0) + 5 * p2) / (self.seen_two[before] + 5))
        return found


def lattice(text: str, read: tuple[int, ...] = ()) -> list[list[tuple[str, float]]]:
    """What each character, or run of one letter, can stand for; the signs at the places ``read`` are not left out."""
    out, i = [], 0
    first = next((k for k, c in enumerate(text) if c.isalnum()), len(text))
    while i < len(text):
        c, n = text[i], 1
        while i + n < len(text) and text[i + n] == c:
            n += 1
        if c.isalpha():
            if n == 1:
                out.append([(c, 0.0)])
            else:
                plain = 0.0 if n == 2 else RUN_COST
                out.append([(c, 3.0 if n == 2 else RUN_COST), (2 * c, plain)])
        elif c.isspace():
            out.append([("", 0.0), (" ", PART_COST)])
        else:
            for _ in range(min(n, 2) if c in LEET else 1):
                options = [(x, LEET_COST) for x in LEET.get(c, "")]
                if c in MASKS:
                    # Others would keep very many states alive in a long row of signs.
                    beside = i + n == first or i > 0 and text[i - 1].isalnum()
                    options += [(x, MASK_COST) for x in (LETTERS if beside else VOWELS)]
                if i in read and options:
                    out.append(options)
                    continue
                out.append([*options, ("", DROP_DIGIT_COST if c.isalnum() else DROP_COST + LEET_COST * (c in LEET))])
        i += n
    return out


def viterbi(text: str, model: Model, read: tuple[int, ...] = ()) -> list[str]:
    """The words of the cheapest path."""
    best: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}  # a path is (path before, letters)
    for options in lattice(text, read):
        after: dict[str, tuple[float, tuple | None]] = {}
        for before, (paid, path) in best.items():
            for letters, cost in options:
                state, total = before, paid + cost
                for x in letters:
                    if x == " ":
                        if state != "^^":
                            total += model.cost(state, "$")
                            state = "^^"
                    else:
                        total += model.cost(state, x)
                        state = state[1] + x
                if state not in after or total < after[state][0]:
                    after[state] = total, (path, letters) if letters else path
        best = after
    ends = [(paid + model.cost(state, "$"), path) for state, (paid, path) in best.items()]
    least = min(paid for paid, _ in ends)
    return min(_along(path) for paid, path in ends if paid == least).split()


def _along(path: tuple | None) -> str:
    letters = []
    while path is not None:
        path, x = path
        letters.append(x)
    return "".join(reversed(letters))


def plain(token: str) -> str | None:
    """The word of a token of letters without a run of three, between any signs, else None."""
    word = token.lower().strip(EDGES)
    return word if (word.isalpha() or not word) and not _RUN.search(word) else None


def one_reading(token: str) -> bool:
    """Whether the lattice of a plain token has one path: no letter is doubled, no sign at its edges stands for letters."""
    return not _READ.search(token.lower()) and not any(d in token for d in DRAWN)


def restored(token: str, model: Model) -> list[str]:
    """The words of one token; of a plain token with several readings, also that without the signs around it."""
    word = plain(token)
    if word is None:
        return _decoded(token, model)
    if one_reading(token):
        return [word] if word else []
    found = [w for w in _decoded(token, model) if any(c.isalpha() for c in w)]
    text = token.lower()
    for drawn, letter in DRAWN.items():
        text = text.replace(drawn, letter)
    letters = [i for i, c in enumerate(text) if c.isalpha()]
    # The sign next to the word is a letter of it: the one before, the one after, or both.
    signs = [i for i in (letters[0] - 1, letters[-1] + 1) if 0 <= i < len(text) and (text[i] in LEET or text[i] in MASKS)] if letters else []
    for read in dict.fromkeys([*((i,) for i in signs), tuple(signs)]) if signs else ():
        start, end = letters[0] - (letters[0] - 1 in read), letters[-1] + 1 + (letters[-1] + 1 in read)
        found += viterbi(text[start:end], model, tuple(i - start for i in read))
    return list(dict.fromkeys([*found, word])) if word else found


def _decoded(token: str, model: Model) -> list[str]:
    """The words of a token by its lattice."""
    word = token.lower().strip(".,;:?\"'«»„“”‘’…")
    for drawn, letter in DRAWN.items():
        word = word.replace(drawn, letter)
    if _NOISE.fullmatch(word[-2:]):
        word = word.rstrip(word[-1])
    if not any(c.isalpha() for c in word):
        return [word] if word else []
    parts = [p for p in _PARTS.split(word) if p]
    if len(parts) > 1 and sum(len(p) > 1 for p in parts) >= len(parts) - 1 and not any(p.isdigit() and len(p) == 1 for p in parts):
        found = [w for p in parts for w in restored(p, model)]
        for short, run in groupby(parts, lambda p: len(p) <= SHORT):
            if short and len(run := list(run)) > 1:
                found += viterbi(" ".join(run), model)
        return list(dict.fromkeys(found))
    found = viterbi(word, model)
    for most in (1, SHORT):  # some parts are words, others pieces of one
        for short, run in groupby(parts, lambda p: len(p) <= most):
            run = list(run)
            if len(run) < len(parts):
                found += viterbi(" ".join(run), model) if short else [w for p in run for w in restored(p, model)]
    return list(dict.fromkeys(found))


def spaced(text: str, model: Model) -> list[str]:
    """The words hidden in runs of single characters."""
    found = []
    for run in _SPACED.finditer(text):
        if sum(c.isalpha() for c in run[0]) >= 3:
            found += viterbi(" ".join(run[0].lower().split()), model)
    return found


def _normal(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def _words(text: bytes) -> list[str]:
    return _normal(text.decode("utf-8", "replace")).split()


class _Classes(dict):
    """Letters that one sign can stand for are one class, as are the signs for them; what is no letter, digit or NUL is nothing."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        found = "il" if c in "il" else "gb" if c in "gb" else LEET.get(c, c if c.isalnum() or c == "\0" else "")
        if found == "b" or found == "g":
            found = "gb"
        elif found in ("i", "l", "li"):
            found = "il"
        self[code] = found[:1] or None
        return self[code]


_CLASSES = _Classes()
_REPEAT = re.compile(r"([^\0])\1+")
_DOUBLE = re.compile(r"(.)\1")
_SIGN = re.compile(rf"[{re.escape(''.join(LEET) + MASKS)}\\]")


def skeleton(text: str) -> str:
    """The classes of the letters and of the signs that stand for some, each run of one class once."""
    for drawn, letter in DRAWN.items():
        if drawn in text:
            text = text.replace(drawn, letter)
    return _REPEAT.sub(r"\1", text.translate(_CLASSES))


class Reachable:
    """Which tokens can be read as a word that has a weight, or that begins like one."""

    def __init__(self, weights: dict[str, float]):
        self.tree: dict = {}
        for part in weights:
            node = self.tree
            for x in part.rstrip("*"):
                node = node.setdefault(x, {})
            node[""] = True
        whole = {skeleton(p) for p in weights if not p.endswith("*")}
        self.words, self.longest = whole, max(map(len, whole), default=0)
        #: Words, and beginnings by their lengths: as they are, and with each run of a letter once.
        self.plain = {p for p in weights if not p.endswith("*")}, self._by_size(p[:-1] for p in weights if p.endswith("*"))
        self.starts = {p.rstrip("*")[:3] for p in weights}
        once = [_REPEAT.sub(r"\1", p) for p in weights]
        self.once_starts = {p.rstrip("*")[:3] for p in once}
        self.once = {p for p in once if not p.endswith("*")}, self._by_size(p[:-1] for p in once if p.endswith("*"))
        self.sure = all(p.rstrip("*").isalpha() for p in weights)
        self.any_word = ahocorasick.Automaton()
        for word in whole:
            self.any_word.add_word(word, word)
        self.any_word.make_automaton()

    def _holds_word(self, text: str) -> bool:
        return bool(self.words) and next(self.any_word.iter(skeleton(text)), None) is not None

    @staticmethod
    def _by_size(beginnings) -> list[tuple[int, set[str]]]:
        found: dict[int, set[str]] = {}
        for p in beginnings:
            found.setdefault(len(p), set()).add(p)
        return sorted(found.items())

    def may_matter(self, token: str) -> bool:
        """False only for tokens none of whose readings has a weight."""
        word = text = token.lower()
        if not text.isalpha():
            word = text.strip(EDGES)
            if not word.isalpha() or _SIGN.search(text):
                return self.token(text)
        # Letters and nothing that stands for one: all readings are the word but for the length of its runs.
        if _DOUBLE.search(word):
            word, (whole, begun), starts = _REPEAT.sub(r"\1", word), self.once, self.once_starts
        else:
            (whole, begun), starts = self.plain, self.starts
        return word[:3] in starts and (word in whole or any(word[:n] in some for n, some in begun))

    def token(self, text: str) -> bool:
        """Whether any path through any part of the token's lattice spells a part that has a weight.

        A word begins where the token does, or after something that can be left out.
        """
        if not self.sure or not any(c.isalpha() for c in text):
            return True  # parts of other signs than letters are told apart by decoding
        drawn_out = text
        for drawn, letter in DRAWN.items():
            drawn_out = drawn_out.replace(drawn, letter)
        return self._walk(drawn_out) or drawn_out != text and self._walk(text)

    def _walk(self, text: str) -> bool:
        nodes: dict[int, dict] = {}
        begins = True
        for options in lattice(text):
            letters = {x for x, _ in options}
            if any(len(x) == 1 and x != " " and cost == MASK_COST for x, cost in options):
                letters.update(LETTERS)  # a part of the token may be read with other neighbours
            if begins:
                nodes[0] = self.tree
            begins = "" in letters or " " in letters
            after = dict(nodes) if begins else {}
            for x in letters:
                if x and x != " ":
                    for node in nodes.values():
                        for c in x:
                            node = node.get(c)
                            if node is None:
                                break
                            if "" in node:
                                return True
                        else:
                            after[id(node)] = node
            nodes = after
        return False

    def spans(self, text: str) -> list[list[str]]:
        """Rows of short tokens, not all of one character, whose letters together may spell a word that has a weight."""
        rows = _PIECES.findall(text)
        if not rows or not self._holds_word("\0".join(rows).lower()):
            return []
        found = []
        for row in rows:
            row = row.lower()
            if self._holds_word(row):
                tokens = row.split()
                for i in range(len(tokens)):
                    if skeleton(tokens[i]):
                        for j in range(i + 2, len(tokens) + 1):
                            own = skeleton("".join(tokens[i:j]))
                            if len(own) > self.longest:
                                break
                            if own in self.words and skeleton(tokens[j - 1]) and any(len(t) > 1 for t in tokens[i:j]):
                                found.append(tokens[i:j])
        return found


def _cased() -> np.ndarray:
    """Which code points below 65536 are small letters of a script with cases, and which are digits (2)."""
    kinds = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        kinds[code] = 1 if c.islower() and c.isalpha() else 2 if c.isdigit() else 0
    return kinds


def _grams(text: str) -> Counter:
    """The trigrams of a text's words, three code points in a number. A word is a run of small letters beside no digit."""
    kinds = _KINDS.setdefault("", None)
    if kinds is None:
        kinds = _KINDS[""] = _cased()
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    kind = kinds[np.where(codes < 1 << 16, codes, 0)]
    letter = kind == 1
    first = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    past = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    good = (kind[first - 1] != 2) & (kind[past] != 2)
    first, past = first[good], past[good]
    size = past - first
    # Word by word: ^ and ^ before it, its letters, and $ after it.
    at = np.repeat(np.cumsum(size + 3) - (size + 3), size) + 2 + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    whole = np.full(int((size + 3).sum()), ord("^"), np.int64)
    whole[at] = codes[np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    whole[np.cumsum(size + 3) - 1] = ord("$")
    # The letters that occur, numbered: a trigram is one number below the cube of their number.
    used = np.zeros(1 << 16, bool)
    used[whole] = True
    alphabet, number = np.flatnonzero(used), np.cumsum(used) - 1
    n, small = len(alphabet), number[whole]
    grams = (small[:-2] * n + small[1:-1]) * n + small[2:]
    inside = np.ones(len(grams), bool)
    ends = np.cumsum(size + 3)[:-1]
    inside[ends - 1] = inside[ends - 2] = False  # from one word to the next
    grams = grams[inside]
    if n**3 <= 1 << 22:
        times = np.bincount(grams)
        grams = np.flatnonzero(times)
        times = times[grams]
    else:
        grams, times = np.unique(grams, return_counts=True)
    codes = alphabet[grams // (n * n)] << 32 | alphabet[grams // n % n] << 16 | alphabet[grams % n]
    return Counter(dict(zip(codes.tolist(), times.tolist())))


_KINDS: dict = {}


def trigrams(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): trigrams of small cased letters in the words of all documents, capitals read as small ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def add(texts: list[bytes]) -> None:
            total.update(_grams(_normal(b" ".join(texts).decode("utf-8", "replace"))))

        for batch in batches:
            held, size = [], 0
            for text in utf8(batch, "body"):
                if text:
                    held.append(text)
                    size += len(text)
                if size > 1 << 20:
                    add(held)
                    held, size = [], 0
            if held:
                add(held)
        spelled = ["".join(chr(g >> s & 0xFFFF) for s in (32, 16, 0)) for g in total]
        yield pa.RecordBatch.from_arrays([pa.array(spelled, pa.string()), pa.array(list(total.values()), pa.int64())], names=["gram", "n"])

    rows = pick(documents, body=text_col)
    return rows.mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def parts_of(word: str) -> list[str]:
    """A word and its beginnings; the beginnings are marked."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


class Restored(dict):
    """The words of tokens and their beginnings; a token of letters is a word as it stands."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> list[str]:
        if len(self) >= REMEMBERED:
            self.clear()
        word = plain(token)
        found = self[token] = [p for w in ([word] if word else restored(token, self.model)) for p in parts_of(w)]
        return found


class Scorer(dict):
    """Weight of a token: the largest of its restored words and their beginnings, 0 for a harmless one.

    A mask before or after a plain word stands for any letter that makes it a toxic one.
    """

    def __init__(self, model: Model, weights: dict[str, float], factors: list[float]):
        super().__init__()
        self.model, self.weights, self.factors = model, weights, factors
        self.reachable = Reachable(weights)

    def of(self, words: list[str]) -> float:
        return max((self.weights.get(p, 0.0) for w in words for p in parts_of(w)), default=0.0)

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[token] = self.weight(token) if self.reachable.may_matter(token) else 0.0
        return found

    def weight(self, token: str) -> float:
        found = self.of(restored(token, self.model))
        if (word := plain(token)) and (masked := _MASKED.search(token.lower())):
            whole = [x + word for x in LETTERS if masked[1]] + [word + x for x in LETTERS if masked[2]]
            found = max(found, max((self.weights.get(w, 0.0) for w in whole), default=0.0))
        return found

    def inputs(self, text: bytes | None) -> list[float]:
        if not text:
            return [1.0, 0.0, 0.0, 0.0]
        whole = text.decode("utf-8", "replace")
        whole = _normal(whole)
        tokens = whole.split()
        hits = [w for w in map(self.__getitem__, tokens) if w]
        hits += [w for x in spaced(whole, self.model) if (w := self.of([x]))]
        hits += [w for row in self.reachable.spans(whole) if (w := self.of(viterbi(" ".join(row), self.model)))]
        return [1.0, math.log1p(len(hits)), math.log1p(sum(hits)), math.sqrt(len(hits) / max(1, len(tokens)))]

    def score(self, text: bytes | None) -> float:
        z = sum(a * b for a, b in zip(self.inputs(text), self.factors))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Regression factors by Newton steps; both classes weigh as they occur."""
    factors = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ factors))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(factors)), x.T @ (y - p) - ridge * factors)
        factors += step
        if np.abs(step).max() < 1e-8:
            break
    return factors.tolist()


#: The scorer of a worker, with all that it remembers, for the tasks that it runs one after the other.
_OWN: dict = {}


def _scorer(key: str, known, factors: list[float]) -> Scorer:
    """The scorer of a broadcast model, which ``key`` names; made once a worker."""
    if key not in _OWN:
        _OWN.clear()
        _OWN[key] = Scorer(Model(known.value[0]), known.value[1], factors)
    return _OWN[key]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str) -> DataFrame:
    """(body, toxic) of the rows to learn from: at most FIT_TOXIC + FIT_CLEAN, near copies mostly once."""
    given = pick(labels, of=label_id_col, toxic=label_col).where(F.col("toxic").isNotNull() & F.col("of").isNotNull())
    given = given.where(~held_out(F.col("of"))).groupBy("of").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["one"]: r["n"] for r in given.groupBy((F.col("toxic") == 1).alias("one")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # A share of each class by hash; a shade less than the bound, which chance could else exceed.
    share = lambda one, most: min(1.0, 0.97 * most / sizes.get(one, 1)) if sizes.get(one, 0) > most else 1.0
    least = F.when(F.col("toxic") == 1, share(True, FIT_TOXIC)).otherwise(share(False, FIT_CLEAN))
    chosen = given.where(F.pmod(F.xxhash64("of"), F.lit(1 << 30)) < least * (1 << 30))
    rows = pick(documents, doc_id=id_col, body=text_col).where("doc_id IS NOT NULL")
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))  # of bounded size
    one = found.groupBy("body").agg(F.max(F.expr("CASE WHEN toxic = 1 THEN 1 ELSE 0 END")).alias("toxic"))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(t or b"").split() for t in utf8(batch, "body")]
            least = [min((xxhash.xxh3_64_intdigest(b" ".join(w[i : i + 5])) >> 1 for i in range(max(1, len(w) - 4))), default=0) for w in split]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=[*batch.schema.names, "lead"])

    marked = one.mapInArrow(lead, "body string, toxic int, lead bigint")
    return marked.groupBy("lead", "toxic").agg(F.min("body").alias("body")).select("body", "toxic")


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_id_col: str = "doc_id", label_col: str = "toxic") -> Scorer:
    """The scorer, from the corpus' trigrams and the labelled sample."""
    context = documents.sparkSession.sparkContext
    model = Model({r["gram"]: r["n"] for r in trigrams(documents, text_col).collect()})
    sample = cut(labelled_sample(documents, labels, id_col, text_col, label_id_col, label_col))
    classes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return Scorer(model, {}, [50.0 if toxic else -50.0, 0.0, 0.0, 0.0])
    shared = context.broadcast(model.three)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value)
        known = Restored(own)
        totals = Counter(), Counter()
        for batch in batches:
            for text, kind in zip(utf8(batch, "body"), batch.column("toxic").to_pylist()):
                if text:
                    found = {p for t in set(_words(text)) for p in known[t]}
                    found.update(p for w in spaced(text.decode("utf-8", "replace"), own) for p in parts_of(w))
                    totals[kind].update(found)
        every = list(totals[0].keys() | totals[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([totals[1][p] for p in every], pa.int64()), pa.array([totals[0][p] for p in every], pa.int64())],
            names=["part", "toxic", "clean"])

    parts = sample.mapInArrow(count, "part string, toxic bigint, clean bigint").groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    sure = parts.withColumn("odds", odds).where((F.col("odds") >= LEAST_ODDS) & (F.col("odds") - ERRORS_BELOW * error >= SURE_ODDS))
    weights = {r["part"]: r["odds"] for r in sure.collect()}
    known, key = context.broadcast((model.three, weights)), uuid.uuid4().hex

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, known, [])
        for batch in batches:
            x = np.array([scorer.inputs(t) for t in utf8(batch, "body")]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(4)] + [batch.column("toxic")], names=["a", "b", "c", "d", "toxic"])

    rows = np.array([tuple(r) for r in sample.mapInArrow(measure, "a double, b double, c double, d double, toxic int").collect()])
    return Scorer(model, weights, logistic(rows[:, :4], rows[:, 4]))



def _shared(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str):
    """What makes the learned scorer in a task."""
    learned = learn(documents, labels, id_col=id_col, text_col=text_col, label_id_col=label_id_col, label_col=label_col)
    known = documents.sparkSession.sparkContext.broadcast((learned.model.three, learned.weights))
    factors, key = learned.factors, uuid.uuid4().hex
    return lambda: _scorer(key, known, factors)


def without_toxic(
    documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    scorer = _shared(documents, labels, id_col, text_col, label_id_col, label_col)

    def prepare():
        own = scorer()
        return lambda texts: [own.score(t) < 0.5 for t in texts]

    return kept_by(documents, text_col, prepare)


def score_toxicity(
    documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scorer = _shared(documents, labels, id_col, text_col, label_id_col, label_col)
    rows = pick(documents, doc_id=id_col, body=text_col)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            own = scorer() if own is None else own
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([own.score(t) for t in utf8(part, "body")], pa.float64())], names=schema.names)

    found = rows.mapInArrow(score, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def restore_text(text: str, model: Model) -> str:
    """The text with hidden words restored, for reading."""
    def line(part: str) -> str:
        part = _SPACED.sub(lambda m: " ".join(viterbi(" ".join(m[0].lower().split()), model)) if sum(c.isalpha() for c in m[0]) >= 3 else m[0], part)
        return " ".join(t if (found := restored(t, model))[:1] == [plain(t)] or not (found or plain(t) is None) else " ".join(found) for t in part.split(" "))

    return "\n".join(line(p) for p in text.split("\n"))
