"""Toxicity by a support vector machine over a gapped subsequence kernel, with Nyström landmarks.

A unit is a word's letters in lower case, or the letters of a run of words of one letter
each, so ``i.d.i.o.t`` and ``i d i o t`` are read as ``idiot``. Words of more than WINDOW
letters are read in overlapping windows.

The kernel of two units sums over all common subsequences of four letters, word bounds
included, that span SPAN letters at most, DECAY to the power of both spans; it is
normalised. An inserted or missing letter changes some spans and leaves the rest.

Training takes at most ``SAMPLE`` labelled texts, those of the lowest hash. Their
sentences get labels from their texts: a toxic text's sentence is toxic if one of its
units stands out by its counts, then by the machine's own margin (the sentence's
witness). Witnesses with a letter too many are learned with them. Landmarks are units that stand out for either label. The machine is fitted on
kernel values against the landmarks, whitened by their own kernel matrix, so its weights
fold into one table of subsequences, and scoring is a sum over table entries.

A text's score is a logistic function of its largest margins over all units of the whole
text, fitted on the sample.

Defined results: null and empty texts have no units and get the score of no margin; texts
with null keys are scored and never trained on; a key with several labels counts with
each; without labels of both kinds the score is 0; repeated rows are scored each; further
columns are left out.
"""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import remainder, sliced

SAMPLE = 5000
LANDMARKS = 512
NEGATIVES = 8_000
#: Rounds of fitting; between them, clean units that come out wrong join the negatives.
TURNS = 3
SPAN = 7
DECAY = 0.85
WINDOW = 16
#: Units whose subsequences are in memory together.
AT_ONCE = 4000
ALPHABET = 32
#: Letters in a subsequence.
ORDER = 4
CACHED_WORDS = 500_000
THRESHOLD = 0.3

_runs = re.compile(r"[^\x20\x09-\x0D]+").findall
_sentences = re.compile(r"[.!?\n]+(?=\s|$)|\n").split
_other = re.compile(r"[\W\d_]+")


@functools.cache
def letter_codes() -> np.ndarray:
    """A small number for each code point of the basic plane: 1 to 26 for a to z, 27 for a word's bound."""
    codes = 28 + np.arange(0x10000) % (ALPHABET - 28)
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[0] = 27
    return codes.astype(np.int32)


def units_of(words: list[str]) -> list[str]:
    """The letters of each word, then those of each run of words of one letter."""
    letters = [_other.sub("", w.lower()) if not w.isalpha() else w.lower() for w in words]
    out, run = [x for x in letters if len(x) > 1], []
    for x in [*letters, "  "]:
        if len(x) == 1:
            run.append(x)
        elif x:
            if len(run) > 2:
                out.append("".join(run))
            run = []
    return out


def windows(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        return [unit]
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - WINDOW // 2, WINDOW // 2)]


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """owner, code, weight: the normalised subsequences of units, sorted by owner and code."""
    bounded = [f"\0{u}\0" for u in units]
    points = np.frombuffer("".join(bounded).encode("utf-32-le"), np.uint32)
    letters = letter_codes()[points & 0xFFFF].astype(np.int64)
    lengths = np.fromiter(map(len, bounded), np.int64, len(units))
    owner = np.repeat(np.arange(len(units)), lengths)
    end = np.cumsum(lengths)[owner]
    at = np.arange(len(letters))
    size, parts, weights = ALPHABET**ORDER, [], []
    for last in range(ORDER - 1, SPAN):
        first = at[at + last < end]
        for middle in itertools.combinations(range(1, last), ORDER - 2):
            code = owner[first]
            for step in (0, *middle, last):
                code = code * ALPHABET + letters[first + step]
            parts.append(code)
            weights.append(np.full(len(first), DECAY ** (last - ORDER + 1)))
    codes, place = np.unique(np.concatenate(parts), return_inverse=True)
    weight = np.bincount(place, np.concatenate(weights), len(codes))
    who = codes // size
    norm = np.sqrt(np.bincount(who, weight**2, len(units)) + 1e-12)
    return who, codes % size, weight / norm[who]


class Machine(NamedTuple):
    """table: the weight of each subsequence; bias; shape: of the logistic function of a text's largest margins."""

    table: np.ndarray
    bias: float
    shape: np.ndarray

    def margins(self, units: list[str]) -> np.ndarray:
        """The margin of each unit, the largest of its windows."""
        return np.concatenate([np.zeros(0), *(self._margins(units[i : i + AT_ONCE]) for i in range(0, len(units), AT_ONCE))])

    def _margins(self, units: list[str]) -> np.ndarray:
        split = [windows(u) for u in units]
        who, code, weight = subsequences([x for w in split for x in w])
        owner = np.repeat(np.arange(len(units)), list(map(len, split)))
        own = np.bincount(who, weight * self.table[code], len(owner)) + self.bias
        out = np.full(len(units), -np.inf)
        np.maximum.at(out, owner, own)
        return out

    def score(self, top: np.ndarray) -> np.ndarray:
        """0 to 1, for rows of the largest margins."""
        return 1 / (1 + np.exp(-np.clip(self.shape[0] + top @ self.shape[1:], -30, 30)))


def largest(margins: Iterable[float]) -> tuple[float, float]:
    """The largest margin and the mean of the three largest, none under -1, which missing ones count as."""
    top = sorted(margins, reverse=True)[:3]
    top = [max(x, -1.0) for x in top] + [-1.0] * (3 - len(top))
    return top[0], sum(top) / 3


def linear_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 300, cost: float = 3000.0) -> np.ndarray:
    """Squared-hinge machine by Newton steps on the support vectors; the last column is of ones, its weight the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        on = y * (x @ w) < 1
        own = x[on].astype(float)
        a = own * (cost * weight[on])[:, None]
        new = np.linalg.solve(ridge + a.T @ own, a.T @ y[on])
        if np.allclose(new, w, atol=1e-6):
            break
        w = w + 0.7 * (new - w)
    return w


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.05 * w
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), slope)
    return w


def witnesses(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, units: list[str]) -> list[str]:
    """Units of toxic texts that stand out, the strongest first. toxic, clean: how many texts have each unit.

    As many toxic texts as hold one would hold it by chance with a probability that leaves less
    than exp(-2) such units among all candidates, and its odds are over 55 to 1.
    """
    candidates = toxic > 2
    least = (np.log(max(1, int(candidates.sum()))) + 2) / np.log((n_toxic + n_clean) / max(1, n_toxic))
    with np.errstate(divide="ignore"):
        odds = np.log(toxic / max(1, n_toxic)) - np.log((clean + 0.5) / (n_clean + 1.0))
    found = np.flatnonzero(candidates & (toxic >= least) & (odds > 4))
    return sorted((units[i] for i in found), key=dict(zip((units[i] for i in found), zip(-toxic[found] * odds[found], (units[i] for i in found)))).__getitem__)


def disguised(unit: str) -> list[str]:
    """A unit with one letter too many, in four ways."""
    out = []
    for turn in range(4 if len(unit) > 3 else 0):
        seed = zlib.crc32(f"{turn}{unit}".encode())
        at = 1 + seed % (len(unit) - 1)
        out.append(unit[:at] + "abeilnorstuxz"[seed // 64 % 13] + unit[at:])
    return out


def shares(n: np.ndarray) -> np.ndarray:
    """The weight of each unit: half alike, half by how many texts have it."""
    return 0.5 / len(n) + 0.5 * (n + 1e-9) / (n + 1e-9).sum()


def all_windows(units: list[str], weights: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The windows of units, and the weight of each."""
    split = [windows(u) for u in units]
    return [w for own in split for w in own], np.repeat(weights / np.array([max(1, len(own)) for own in split]), list(map(len, split)))


class Basis:
    """Landmarks and what whitens kernel values against them."""

    def __init__(self, landmarks: list[str]):
        who, code, weight = subsequences(landmarks)
        self.codes, place = np.unique(code, return_inverse=True)
        self.rows = np.zeros((len(landmarks), len(self.codes)), np.float32)
        self.rows[who, place] = weight
        values, vectors = np.linalg.eigh((self.rows @ self.rows.T).astype(float))
        keep = values > 1e-3
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])
        self.known = np.full(ALPHABET**ORDER, -1)
        self.known[self.codes] = np.arange(len(self.codes))

    def features(self, units: list[str]) -> np.ndarray:
        """Whitened kernel values of windows, and a last column of ones."""
        out = np.ones((len(units), self.whiten.shape[1] + 1), np.float32)
        for i in range(0, len(units), 1000):
            part = units[i : i + 1000]
            who, code, weight = subsequences(part)
            at = self.known[code]
            rows = np.zeros((len(part), len(self.codes)), np.float32)
            rows[who[at >= 0], at[at >= 0]] = weight[at >= 0]
            out[i : i + len(part), :-1] = rows @ self.rows.T @ self.whiten
        return out

    def machine(self, positive: list[str], of_positive: np.ndarray, negative: list[str], of_negative: np.ndarray) -> Machine:
        """A machine whose weights are folded into one table of subsequences. All windows of a unit have its label and share its weight."""
        positive, of_positive = all_windows(positive, of_positive)
        negative, of_negative = all_windows(negative, of_negative)
        x = np.vstack([self.features(positive), self.features(negative)])
        sign = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        w = linear_svm(x, sign, np.concatenate([of_positive, of_negative]))
        table = np.zeros(ALPHABET**ORDER)
        table[self.codes] = (self.whiten @ w[:-1]) @ self.rows
        return Machine(table, float(w[-1]), np.zeros(3))


def train(texts: list[str], labels: list[int]) -> Machine | None:
    """A machine from labelled texts; None where a label is missing or no unit tells them apart."""
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    number: dict[str, int] = {}  # of each unit
    seen: list[np.ndarray] = []
    toxic_sentences: list[np.ndarray] = []
    openings: set[bytes] = set()
    first = np.zeros(len(y), bool)  # of texts whose longest sentences are alike, one counts
    for at, text in enumerate(texts):
        bag = [np.unique(np.array([number.setdefault(u, len(number)) for u in units_of(_runs(s))], np.int32)) for s in _sentences(text)]
        seen.append(np.unique(np.concatenate(bag)))
        longest = max(bag, key=len).tobytes()
        first[at] = longest not in openings
        openings.add(longest)
        if y[at]:
            toxic_sentences += [s for s in bag if len(s)]
    units = list(number)

    def counts(which: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([np.zeros(0, np.int32), *(seen[i] for i in np.flatnonzero(which))]), minlength=len(units))

    clean, toxic = counts(y == 0), counts(y == 1)
    witness = witnesses(counts((y == 1) & first), clean, int(((y == 1) & first).sum()), int((y == 0).sum()), units)
    if not witness:
        return None
    known = np.zeros(len(units), bool)
    known[[number[u] for u in witness]] = True
    toxic_sentences = [s for s in toxic_sentences if known[s].any()]
    everyone = np.flatnonzero(clean)
    order = everyone[np.argsort(-clean[everyone], kind="stable")]
    spread = [*order[: NEGATIVES // 2], *order[NEGATIVES // 2 :: max(1, len(order) // (NEGATIVES // 2))]]
    negative = list(dict.fromkeys(units[i] for i in spread))
    common = negative[: LANDMARKS // 4]
    loud: list[str] = []
    weights = lambda words, n: shares(np.array([n[number[u]] for u in words], float))
    for turn in range(TURNS):
        basis = Basis(list(dict.fromkeys(w for u in [*witness[: LANDMARKS // 2], *loud[: LANDMARKS // 4], *common] for w in windows(u))))
        altered = {x: u for u in witness for x in disguised(u) if x not in number}
        weight = np.concatenate([weights(witness, toxic), 0.5 * weights([*altered.values()], toxic)]) if altered else weights(witness, toxic)
        machine = basis.machine([*witness, *altered], weight, negative, weights(negative, clean))
        margin = machine.margins(units)
        if turn + 1 < TURNS:  # clean units that the machine gets wrong, and witnesses of toxic sentences by its own margin
            worst = everyone[np.argsort(-(margin[everyone] + 0.1 * np.log1p(clean[everyone])), kind="stable")][:NEGATIVES]
            worst = worst[margin[worst] > -0.7]
            loud = [units[i] for i in worst[np.argsort(-clean[worst], kind="stable")]]
            negative = list(dict.fromkeys([*negative, *loud]))
            best = {int(s[margin[s].argmax()]) for s in toxic_sentences}
            new = {units[i] for i in best if margin[i] > 0.5 and toxic[i] > 1 and not clean[i]}
            witness = [*witness, *sorted(new.difference(witness))]
    tops = np.array([largest(margin[s].tolist()) for s in seen])
    return machine._replace(shape=logistic(tops, y))


class Scorer:
    """Scores texts and remembers the margins of words."""

    def __init__(self, machine: Machine | None):
        self.machine, self.known = machine, {}
        self.single: dict[str, str] = {}  # words of one letter

    def learn(self, words: set[str]) -> None:
        new = list(words)
        units = [u[0] if (u := units_of([w])) else "" for w in new]
        real = sorted({u for u in units if u})
        margin = dict(zip(real, self.machine.margins(real))) if real else {}
        self.single.update((w, x.lower()) for w in new if len(w) < 6 and len(x := _other.sub("", w)) == 1)
        self.known.update((w, float(margin.get(u, -9.0))) for w, u in zip(new, units))

    def of_runs(self, words: list[str]) -> list[float]:
        """Margins of runs of words of one letter each."""
        letters = "".join(map(self.single.get, words, itertools.repeat(" ")))
        runs = sorted({x for x in letters.split() if len(x) > 2})
        return self.machine.margins(runs).tolist() if runs else []

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.machine is None:
            return np.zeros(len(texts))
        tops = []
        for i in range(0, len(texts), 64):  # new words of some texts together
            split = [_runs(t or "") for t in texts[i : i + 64]]
            distinct = [{*words} for words in split]
            new = set().union(*distinct).difference(self.known)
            if len(self.known) + len(new) > CACHED_WORDS:
                self.known.clear()
                self.single.clear()
                new = set().union(*distinct)
            self.learn(new)
            for words, own in zip(split, distinct):
                margins = list(map(self.known.__getitem__, own))
                if not own.isdisjoint(self.single):
                    margins += self.of_runs(words)
                tops.append(largest(margins))
        return self.machine.score(np.array(tops).reshape(-1, 2)) if tops else np.zeros(0)


def fit(documents: DataFrame, labels: DataFrame, divisor: int = 4, held: int = 2, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Machine | None:
    """Fits on at most ``sample`` labelled texts whose key's crc32, modulo ``divisor``, isn't ``held``."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter((remainder(F.col("key"), divisor) != held) & F.col("label").isin(0, 1)).distinct()
    chosen = known.orderBy(F.xxhash64("key"), "key", "label").limit(sample)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "key")  # sample rows at most
    found = rows.orderBy(F.xxhash64("key"), "key", "label", F.xxhash64("text")).limit(sample).select("text", "label").coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += [x or "" for x in batch.column(0).to_pylist()]
            marks += batch.column(1).to_pylist()
        machine = train(texts, marks)
        if machine is not None:
            yield pa.RecordBatch.from_pylist([{"weights": machine.table.tobytes(), "bias": machine.bias, "shape": machine.shape.tobytes()}])

    # a task fits it, which the driver has no room for; the driver gets the machine alone
    for weights, bias, shape in found.mapInArrow(run, "weights binary, bias double, shape binary").collect():
        return Machine(np.frombuffer(bytes(weights)), bias, np.frombuffer(bytes(shape)))
    return None


def score(documents: DataFrame, machine: Machine | None, columns: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The named columns of ``documents`` with score (double) and predicted (int)."""
    cast = documents.select(*columns, F.col(text).cast("string").alias("_scored"))
    names = [*columns, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for batch in sliced(batches, len(columns)):
            scores = scorer.scores(batch.column(len(columns)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cast.schema if f.name != "_scored")
    return cast.mapInArrow(run, f"{fields}, score double, predicted int")
