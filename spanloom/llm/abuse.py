"""Scores of abusive, hateful and sexual content (problem 8).

Writers hide words by digits for letters, signs over letters, blanks or dashes between letters,
repeated letters and look-alike alphabets. A character trigram model is counted over all
documents; tokens that look disturbed are read as lattices of letters, of which Viterbi
decoding finds the likeliest under the model and the costs of the disturbances. The restored
text is scored sentence by sentence by a logistic model over its words, their letters, and the
senses of listed words beside each other, fitted on a labelled sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, combinations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import labelled, lexicon
from spanloom.llm.tokenizer import text_chunks

#: Score from which a document counts as a case.
THRESHOLD = 0.5
#: Decoded tokens remembered by a worker.
REMEMBERED = 100_000
#: Log-probability that the model's letters are rather listed words.
LISTED_BONUS = 9.0
#: Words of a sentence that are scored together; longer ones are scored in stretches of that many, each overlapping half of the next.
STRETCH = 40
#: Buckets of hashed features; penalty, steps and rate of the fit.
BUCKETS, PENALTY, STEPS, RATE = 1 << 18, 2e-6, 200, 0.1
#: Weight of a plain sentence of the corpus beside a labelled one, and the score from which it is doubted.
PLAIN_WEIGHT, DOUBT = 5.0, 0.1
#: Documents drawn by hash whose sentences without listed words serve as plain ones, about, and such sentences at most.
SAMPLE_DOCUMENTS, SAMPLE_SENTENCES = 500, 5000

_INVISIBLE = re.compile(f"[{lexicon.INVISIBLE}]")
_MARKS = re.compile("[̀-ͯ]")
_WORD = re.compile(r"[a-z]{2,24}|[а-я]{2,24}")
_LETTER = "a-zа-яіїјѕһԁԛԝ"
_SIGN = re.escape("@$!|€" + lexicon.MASKS)
_APART = re.compile(rf"(?<![{_LETTER}0-9])[{_LETTER}]([-_.*~ ])[{_LETTER}](?:\1[{_LETTER}])+(?![{_LETTER}0-9])")  # letters set apart
_NOISY = re.compile(
    rf"(?<![{_LETTER}0-9.@])(?=[0-9{_SIGN}]*[{_LETTER}])[{_LETTER}0-9{_SIGN}]*[0-9{_SIGN}][{_LETTER}0-9{_SIGN}]*(?![{_LETTER}0-9]|\.[{_LETTER}])"  # digits or signs among letters
    rf"|[{_LETTER}]*([{_LETTER}])\1\1[{_LETTER}]*"  # letters repeated
    rf"|(?=[a-z]*[{_LETTER[3:]}])(?=[{_LETTER[3:]}]*[a-z])[{_LETTER}]+"  # alphabets mixed
)
_DISTURBED = re.compile(rf"[0-9{_SIGN}][^\W_]|[^\W_][0-9{_SIGN}]|([^\W_])\1\1|[a-z][{_LETTER[3:]}]|[{_LETTER[3:]}][a-z]")
_NAME_AND_NUMBER = re.compile(rf"[{_LETTER}]{{3,}}[0-9]{{1,2}}|[0-9]+[{_LETTER}]{{1,2}}|@[{_LETTER}]+|[{_LETTER}]+[!|]+")
_END = r"[.!?;…。！？\n]+(?=\s|$|[^\x00-\x7f])|\n"
_SENTENCE = re.compile(_END)
_ENDS = frozenset(".!?;…。！？\n")
_PARTS = re.compile(rf"[぀-ヿ一-鿿]{{1,{STRETCH}}}|[^\W_぀-ヿ一-鿿]+|{_END}")  # words and ends of sentences
_UTF8_AS = re.compile("[ÃÐÑÂã][\u0080-¿€-™]|[РС][°-џЂ-Џ]")

_LATIN_OF_1251 = {}
for _b in range(0xC0, 0x100):
    _latin = _MARKS.sub("", unicodedata.normalize("NFKD", bytes([_b]).decode("latin-1"))).casefold()
    _cyr = bytes([_b]).decode("cp1251").lower()
    if len(_latin) == 1 and _latin.isascii() and _latin.isalpha():
        _LATIN_OF_1251.setdefault(_MARKS.sub("", unicodedata.normalize("NFKD", _cyr)), _latin)


def repair(text: str) -> str:
    """Text whose bytes were read in a false charset, read anew line by line where that is certain."""
    if not _UTF8_AS.search(text):
        return text
    out = []
    for line in text.split("\n"):
        if _UTF8_AS.search(line):
            for charset in ("cp1252", "latin-1", "cp1251"):
                try:
                    line = line.encode(charset).decode("utf-8")
                    break
                except UnicodeError:
                    continue
        out.append(line)
    return "\n".join(out)


def fold(text: str) -> str:
    """Lower case without accents and characters without width; compatible forms made plain."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)).casefold())


def _entries(block: str) -> list[str]:
    """Listed words and phrases, folded. A line with bars lists phrases, another one words."""
    lines = block.strip().split("\n")
    return [fold(x.strip()) for line in lines for x in (line.split("|") if "|" in line else line.split()) if x.strip()]


#: Senses that a sentence is searched for, and those that count only beside them.
CUES = ("INSULT", "MILD", "HARM", "DEGRADE", "EXPEL", "SLUR", "EXPLICIT", "SENSUAL")
COMPANY = ("ADDRESS", "GROUP", "PERSON", "ABOUT")


def _letter(c: str) -> bool:
    return c.isalnum() and c < "぀"  # Japanese sets no blanks


class Lists:
    """Listed words in an automaton."""

    def __init__(self, categories: tuple[str, ...]) -> None:
        kinds: dict[str, set[str]] = {}
        for category in categories:
            for entry in _entries(getattr(lexicon, category)):
                kinds.setdefault(entry, set()).add(category)
        self.automaton = ahocorasick.Automaton()
        for entry, found in kinds.items():
            stem = entry.rstrip("*")
            self.automaton.add_word(stem, (len(stem), entry.endswith("*"), frozenset(found)))
        self.automaton.make_automaton()
        self.words = {w.rstrip("*") for e in kinds for w in e.split(" ") if len(w) > 2} | {e.rstrip("*") for e in kinds}

    def hits(self, text: str) -> dict[tuple[int, int], frozenset[str]]:
        """Categories of entries that stand as words, by (place, end)."""
        out = {}
        last = len(text) - 1
        for end, (size, open_, found) in self.automaton.iter(text):
            begin = end - size + 1
            if _letter(text[end]) and (begin and _letter(text[begin - 1]) or not open_ and end < last and _letter(text[end + 1])):
                continue
            out[begin, end + 1] = found
        return out


def counted(hits: dict[tuple[int, int], frozenset[str]]) -> Counter:
    """Hits by category; a word within a longer entry of the same category counts once with it."""
    count: Counter = Counter()
    for (a, b), found in hits.items():
        for c in found:
            if not any(x <= a and b <= y and (x, y) != (a, b) and c in f for (x, y), f in hits.items()):
                count[c] += 1
    return count


def words_of(text: str) -> list[str]:
    """Words of a folded text; of scripts without blanks, runs of up to STRETCH characters."""
    return [w for w in _PARTS.findall(text) if w[0] not in _ENDS]


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def word_features(word: str) -> dict[int, float]:
    """A word and, weighing half as much in all, its pieces of four letters; of a run without blanks every two neighbouring characters."""
    out: dict[int, float] = {}
    if word[0] >= "\u3040":
        for pair in {word[i : i + 2] for i in range(max(1, len(word) - 1))}:
            out |= word_features_of_one(pair)
        return out
    return word_features_of_one(word)


def word_features_of_one(word: str) -> dict[int, float]:
    out: dict[int, float] = {_bucket("word " + word): 1.0}
    padded = f"<{word}>"
    pieces = [padded[i : i + 4] for i in range(len(padded) - 3)]
    for piece in pieces:
        k = _bucket("piece " + piece)
        out[k] = out.get(k, 0.0) + 0.5 / len(pieces)
    return out


def sense_features(count: Counter) -> list[int]:
    """Senses of a sentence, alone, repeated and beside each other."""
    present = sorted(c for c in count if count[c])
    names = ["one " + c for c in present] + ["more " + c for c in present if count[c] > 1] + [f"two {a} {b}" for a, b in combinations(present, 2)]
    return [_bucket(n) for n in names]


def _fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray, bias: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and biases of a logistic model of each kind, from a sparse matrix with weighted rows, and the rows' log-odds; from w and bias on."""
    kinds, columns = y.shape[1], len(w)
    first, second, first_b, second_b = np.zeros_like(w), np.zeros_like(w), np.zeros(kinds), np.zeros(kinds)
    for step in range(1, steps + 1):
        z = np.stack([np.bincount(row, value * w[column, k], len(y)) for k in range(kinds)], 1) + bias
        error = weight * (1 / (1 + np.exp(-z)) - y) / weight.sum()
        slope = np.stack([np.bincount(column, value * error[row, k], columns) for k in range(kinds)], 1) + PENALTY * w
        slope_b = error.sum(0)
        first, first_b = 0.9 * first + 0.1 * slope, 0.9 * first_b + 0.1 * slope_b
        second, second_b = 0.999 * second + 0.001 * slope**2, 0.999 * second_b + 0.001 * slope_b**2
        fix = RATE * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= fix * first / (np.sqrt(second) + 1e-8)
        bias -= fix * first_b / (np.sqrt(second_b) + 1e-8)
    return w, bias, z


@lru_cache(maxsize=4)
def fitted(plain: tuple[str, ...] = (), leave_out: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS, kinds) and biases of the scorer, fitted on the labelled sample and plain sentences of the corpus.

    Of plain those without a listed word count; those that still look like labelled ones (DOUBT)
    are left out in a second fit. leave_out names a fifth of the labelled lines,
    0 to 4, that take no part.
    """
    cues, company = Lists(CUES), Lists(COMPANY)
    told = [(fold(t), k) for n, (_, t, k) in enumerate(labelled.sample(leave_out=leave_out))]
    sentences = [t for t, _ in told] + [t for t in plain if not cues.hits(t)]
    y = np.zeros((len(sentences), len(labelled.KINDS)))
    y[: len(told)] = [k for _, k in told]
    rows, columns, values = [], [], []
    for n, text in enumerate(sentences):
        features: Counter = Counter()
        for w in set(words_of(text)):
            features.update(word_features(w))
        hits = cues.hits(text)
        if hits:
            features.update(sense_features(counted(hits) + counted(company.hits(text))))
        rows += [n] * len(features)
        columns += features.keys()
        values += features.values()
    row, column, value = np.array(rows), np.array(columns), np.array(values, float)
    used = np.unique(column[row < len(told)])  # what only plain sentences have tells nothing
    kept = np.isin(column, used)
    weight = np.full((len(y), 1), PLAIN_WEIGHT)
    weight[: len(told)] = 1.0
    matrix = row[kept], np.searchsorted(used, column[kept]), value[kept]
    w, bias, z = _fit(*matrix, y, weight, np.zeros((len(used), y.shape[1])), np.full(y.shape[1], -3.0), STEPS)
    doubted = (np.arange(len(y)) >= len(told)) & (z.max(1) > math.log(DOUBT / (1 - DOUBT)))
    if doubted.any():
        weight[doubted] = 0.0
        w, bias, _ = _fit(*matrix, y, weight, w, bias, STEPS // 3)
    weights = np.zeros((BUCKETS, y.shape[1]), np.float32)
    weights[used] = w
    return weights, bias


class Model:
    """Interpolated character trigrams; words begin and end with a blank."""

    def __init__(self, counts: dict[str, float], words: set[str]):
        tri: Counter = Counter(counts)
        weight = max(1.0, sum(counts.values()) / 2e5)
        for word in words:
            padded = f"  {word} "
            for i in range(len(padded) - 2):
                tri[padded[i : i + 3]] += weight
        self.tri, self.bi, self.uni = tri, Counter(), Counter()
        self.ctx2, self.ctx1 = Counter(), Counter()
        for t, n in tri.items():
            self.bi[t[1:]] += n
            self.uni[t[2]] += n
            self.ctx2[t[:2]] += n
            self.ctx1[t[1]] += n
        self.total = sum(self.uni.values()) or 1.0
        self.known: dict[str, float] = {}

    def log(self, context: str, c: str) -> float:
        key = context + c
        found = self.known.get(key)
        if found is None:
            p3 = self.tri[key] / self.ctx2[context] if self.ctx2[context] else 0.0
            p2 = self.bi[key[1:]] / self.ctx1[context[1]] if self.ctx1[context[1]] else 0.0
            found = self.known[key] = math.log(0.75 * p3 + 0.2 * p2 + 0.05 * (self.uni[c] + 0.01) / self.total)
        return found


class Restorer(dict):
    """Viterbi decoding of disturbed tokens; remembers what stands between blanks as it was read.

    A state is the last two letters (what the model looks at), the beginning of a listed word
    read since the last blank, or else how many letters, and whether only listed words and
    words of two letters came before. No reading is left out, so the best one is found.
    """

    def __init__(self, model: Model, words: set[str]):
        super().__init__()
        self.model, self.words, self.memory = model, words, {}
        self.beginnings = {w[:i] for w in self.words for i in range(len(w) + 1)}
        self.latin, self.cyrillic = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщъыьэюя"

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each place the letters it may stand for, with the cost of that."""
        cyrillic = sum("а" <= c <= "я" for c in token)
        latin = sum("a" <= c <= "z" for c in token)
        mixed = cyrillic and latin
        letters = self.cyrillic if cyrillic > latin else self.latin
        out: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(token):
            c = token[i]
            run = i
            while run < len(token) and token[run] == c:
                run += 1
            if c.isalpha():
                own = [(c, 0.0)]
                if mixed and not c.isascii():
                    own = [(x, 0.3) for x in {lexicon.LOOKALIKE.get(c), _LATIN_OF_1251.get(c)} if x] or [(c, 3.0)]
                elif not mixed and c in "іїјѕһԁԛԝ":
                    own = [(lexicon.LOOKALIKE[c], 0.3)]
                if run - i >= 3:
                    out.append([(x * n, k + cost) for x, k in own for n, cost in ((1, 0.0), (2, 0.7), (3, 4.0))])
                else:
                    out += [own] * (run - i)
            else:
                own = [(x, 0.5) for x in lexicon.LEET.get(c, "")]
                if c in lexicon.MASKS:
                    own += [(x, 2.2) for x in letters if x not in lexicon.LEET.get(c, "")] + [(" ", 3.0)]
                out += [own or [(c, 1.0)]] * (run - i)
            i = run
        return out

    def after(self, read: str | int, flag: int, c: str) -> tuple[str | int, int]:
        """What was read of a word, and the flag, after one more letter or blank.

        read is a beginning of listed words, or a number of letters up to 3; flag is 0 before
        any word, 1 after listed words, 2 after words of two letters alone, 3 after another word.
        """
        if c == " ":
            size = len(read) if isinstance(read, str) else read
            if not size:
                return "", flag
            if isinstance(read, str) and read in self.words:
                return "", 1 if flag < 3 else 3
            return "", flag if size == 2 and flag == 1 else 2 if size == 2 and flag in (0, 2) else 3
        if isinstance(read, str):
            grown = read + c
            return (grown if grown in self.beginnings else min(len(grown), 3)), flag
        return min(read + 1, 3), flag

    def decode(self, token: str) -> str:
        found = self.memory.get(token)
        if found is not None:
            return found
        log, after = self.model.log, self.after
        states: dict[tuple, float] = {("  ", "", 0): 0.0}
        back: list[dict[tuple, tuple[tuple, str]]] = []
        for options in self.lattice(token):
            grown: dict[tuple, float] = {}
            came: dict[tuple, tuple[tuple, str]] = {}
            for state, score in states.items():
                for letters, cost in options:
                    s, (context, read, flag) = score - cost, state
                    for c in letters:
                        s += log(context, c)
                        context = context[1] + c
                        read, flag = after(read, flag, c)
                    to = (context, read, flag)
                    if s > grown.get(to, -math.inf):
                        grown[to], came[to] = s, (state, letters)
            states = grown
            back.append(came)
        state = max(states, key=lambda x: states[x] + log(x[0], " ") + LISTED_BONUS * (after(x[1], x[2], " ")[1] == 1))
        parts = []
        for came in reversed(back):
            state, letters = came[state]
            parts.append(letters)
        best = "".join(reversed(parts))
        if len(self.memory) >= REMEMBERED:
            self.memory.clear()
        self.memory[token] = best
        return best

    def listed(self, text: str) -> bool:
        words = [w for w in text.split(" ") if w]
        return any(w in self.words for w in words) and all(w in self.words or len(w) == 2 for w in words)

    def _read(self, match: re.Match) -> str:
        token = match.group(0)
        # a name with a number, a handle or a list mark, unless it reads as listed words
        named = bool(_NAME_AND_NUMBER.fullmatch(token))
        marked = token[0] in "@#$*_!|" and len(token) > 1 and token[1:].isalpha()
        if named or marked:
            read = self.decode(token)
            if self.listed(read):
                return read
            if named:
                return token
        head = tail = ""
        if marked:
            head, token = token[0], token[1:]
        while token and token[-1] in "!|":
            token, tail = token[:-1], token[-1] + tail
        return head + (self.decode(token) if token else "") + tail

    def __missing__(self, token: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = read = _NOISY.sub(self._read, token) if _DISTURBED.search(token) else token
        return read

    def restore(self, folded: str) -> str:
        joined = _APART.sub(lambda m: self.decode(m.group(0)[::2]), folded)
        return " ".join(map(self.__getitem__, joined.split(" ")))


class Words(dict):
    """Number of each word met, 0 for ends of sentences; rows of weights by that number."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.rows = weights, np.zeros((1024, weights.shape[1]))

    def __missing__(self, word: str) -> int:
        if word[0] in _ENDS:
            self[word] = 0
            return 0
        n = len(self) + 1
        if n >= len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        features = word_features(word)
        self.rows[n] = np.fromiter(features.values(), float) @ self.weights[list(features)]
        self[word] = n
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Scorer:
    def __init__(self, counts: dict[str, float], model: tuple[np.ndarray, np.ndarray] | None = None):
        self.weights, self.bias = model or fitted()
        self.cues, self.company = Lists(CUES), Lists(COMPANY)
        taught = {w for _, sentence, kinds in labelled.sample() if any(kinds) for w in words_of(fold(sentence)) if len(w) > 2 and w < "\u3040"}
        words = self.cues.words | self.company.words | taught
        self.restorer = Restorer(Model(counts, words), words)
        self.words = Words(self.weights)

    def score(self, text: str) -> tuple[float, float, float]:
        return tuple(self.scores([text])[0].tolist())

    def scores(self, texts: list[str]) -> np.ndarray:
        """Scores of abuse, hate and sexual content of each text: the greatest of its sentences."""
        return self.restored_scores([self.restorer.restore(fold(repair(t))) for t in texts])

    def restored_scores(self, texts: list[str]) -> np.ndarray:
        parts = [[*_PARTS.findall(t), "\n"] for t in texts]  # every text ends its last sentence
        number = self.words.numbers(list(chain.from_iterable(parts)))
        end = number == 0
        sentence = np.cumsum(end) - end
        sizes = np.cumsum([len(p) for p in parts])
        first = np.concatenate(([0], sentence[sizes[:-1]])) if len(sizes) > 1 else np.zeros(1, np.int64)  # each text's first sentence
        count = np.bincount(sentence[~end], minlength=int(sentence[-1]) + 1)
        # a word counts once in a sentence
        key = sentence * (int(number.max()) + 1) + number
        key.sort()
        at, word = np.divmod(key[np.concatenate(([True], key[1:] != key[:-1]))], int(number.max()) + 1)
        z = np.stack([np.bincount(at, self.words.rows[word, k], len(count)) for k in range(len(self.bias))], 1) + self.bias
        z[count == 0] = -50.0
        stretches = {k: self._stretched(number[np.searchsorted(sentence, k) :][: count[k]]) for k in np.flatnonzero(count > STRETCH).tolist()}
        for text, base in zip(texts, first.tolist(), strict=True):
            hits = self.cues.hits(text)
            if not hits:
                continue
            ends = [0, *[m.end() for m in _SENTENCE.finditer(text)], len(text)]
            inside: dict[tuple[int, int, int, int], dict[tuple[int, int], frozenset[str]]] = {}
            for span, found in hits.items():
                k = bisect_right(ends, span[0]) - 1
                for part in self._parts_of(text, k, ends, span, base + k in stretches):
                    inside.setdefault(part, {})[span] = found
            for (k, n, a, b), own in inside.items():
                extra = self.weights[sense_features(counted(own) + counted(self.company.hits(text[a:b])))].sum(0)
                if base + k in stretches:
                    stretches[base + k][n] += extra
                else:
                    z[base + k] += extra
        for k, rows in stretches.items():
            z[k] = rows.max(0)
        best = np.maximum.reduceat(z, first)
        return np.where(best <= -50, 0.0, 1 / (1 + np.exp(-np.clip(best, -50, 50))))

    def _stretched(self, number: np.ndarray) -> np.ndarray:
        """Log-odds of the stretches of a long sentence."""
        return np.array([self.words.rows[np.unique(number[a:b])].sum(0) for a, b in _stretches(len(number))]) + self.bias

    def _parts_of(self, restored: str, k: int, ends: list[int], span: tuple[int, int], long: bool) -> list[tuple[int, int, int, int]]:
        """(sentence, stretch, begin, end) of the stretches that hold a span."""
        a, b = ends[k], ends[k + 1]
        if not long:
            return [(k, 0, a, b)]
        places = [(a + m.start(), a + m.end()) for m in _PARTS.finditer(restored[a:b]) if m.group()[0] not in _ENDS]
        parts = [(k, n, places[x][0], places[y - 1][1]) for n, (x, y) in enumerate(_stretches(len(places)))]
        return [p for p in parts if p[2] <= span[0] and span[1] <= p[3]] or [p for p in parts if p[2] <= span[0] < p[3]]


def _stretches(n: int) -> list[tuple[int, int]]:
    """[first, last) of stretches of STRETCH words, each half over the next, that cover n words."""
    return [(a, min(a + STRETCH, n)) for a in range(0, max(n - STRETCH // 2, 1), STRETCH // 2)]


def trigram_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """(trigram, n) over the words of all documents, folded; within the Latin and Cyrillic alphabets.

    At most 27^3 + 33^3 rows, so the result may be collected.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for _, texts in text_chunks(batch[0]):
                counts.update(_WORD.findall(fold("\n".join(texts))))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for word, n in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                padded = f"  {word} "
                for i in range(len(padded) - 2):
                    counts[padded[i : i + 3]] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["trigram", "n"])

    counted = documents.select(F.col(text).cast("string")).mapInArrow(words, "word string, n long")
    return counted.mapInArrow(trigrams, "trigram string, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def plain_sample(documents: DataFrame, text: str = "text") -> tuple[str, ...]:
    """Sentences of a sample of about SAMPLE_DOCUMENTS documents, drawn by the hash of their text; SAMPLE_SENTENCES at most."""
    texts = documents.where(F.length(text) > 0).select(F.col(text).cast("string").alias("t"))
    share = min(1.0, SAMPLE_DOCUMENTS / max(texts.count(), 1))
    drawn = texts.where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    found = {x.strip() for r in drawn.collect() for x in _SENTENCE.split(fold(repair(r["t"])))}
    return tuple(sorted((x for x in found if 1 < len(words_of(x)) <= STRETCH), key=lambda x: zlib.crc32(x.encode()))[:SAMPLE_SENTENCES])


_SCORERS: dict[int, Scorer] = {}


def _scorer(told) -> Scorer:
    """The worker's scorer by a broadcast's trigram counts and weights, made once."""
    key = hash((len(told.value[0]), sum(told.value[0].values()), float(told.value[1][0].sum())))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(*told.value)
    return _SCORERS[key]


def scores(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns of every document and its scores: abuse, hate, sexual, and score, the greatest.

    Each is between 0 and 1, the greatest over the sentences of the whole text. Null, empty and
    blank texts score 0. Repeated rows are each scored; an empty table gives an empty one.
    """
    counts = {r["trigram"]: float(r["n"]) for r in trigram_counts(documents, text).collect()}
    told = documents.sparkSession.sparkContext.broadcast((counts, fitted(plain_sample(documents, text))))
    wanted = documents.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema[: len(keep)]) + ", abuse double, hate double, sexual double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(told)
        for batch in batches:
            rows = [scorer.scores([t or "" for t in texts]) for _, texts in text_chunks(batch[len(keep)])]
            found = np.concatenate(rows) if rows else np.zeros((0, 3))
            columns = [*found.T, found.max(1) if len(found) else found[:, 0]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *[pa.array(c) for c in columns]], names=[*keep, "abuse", "hate", "sexual", "score"])

    return wanted.mapInArrow(score, schema)


def rates(scored: DataFrame) -> DataFrame:
    """Of each source (null is one) its documents, cases and their rate, by kind."""
    case = lambda c: F.sum((F.col(c) >= THRESHOLD).cast("long"))
    counted = scored.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), *[case(c).alias(f"{c}_cases") for c in ("abuse", "hate", "sexual")], case("score").alias("cases"))
    return counted.withColumn("rate", F.col("cases") / F.col("documents"))
