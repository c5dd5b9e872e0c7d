"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Kernel: two words are as alike as the gap-weighted subsequences of three characters they share
(word ends marked): a subsequence weighs ``DECAY`` to the power of the span it covers, so inserted
characters and gaps lower a match and do not lose it. Kernel values are normalized.

Training (``train``), from labelled documents only, cut into sentences:

* At most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean labelled documents, those of the smallest id
  hash, equal texts once. This sample bound is the only limit; scoring covers every text.
* Sentences of clean documents are clean, and so are all their words. A sentence of a toxic
  document is toxic if it holds a witness: at first a word that is over-represented in toxic
  documents and in no clean one, later also the highest-scoring word of each toxic document.
* Landmarks are witness words and clean words; a linear machine (squared hinge, Newton steps) is
  fitted on the Nystroem features, and refitted with the clean words it scores highest (found by
  Spark over all words of the clean sample) and with the new witnesses.
* The machine's weights over landmarks collapse to one weight per subsequence, a table of 2^20
  numbers: scoring a word needs its own subsequences only.

A sentence scores as its highest word; a text as its highest word and its second highest, since
toxic texts rarely hold one such word alone and chance likenesses do. Runs of single characters are
read as one word too. A logistic curve fitted on the sample's texts turns the two into 0 to 1.

Null and empty texts get the score of a text without words. Repeated rows each get their score.
Labels that are null count as absent; an id labelled twice is toxic if any label says so. Without
any toxic or any clean label the machine cannot be fitted and every text scores 0. Other columns
are kept; the result columns replace columns of the same names.
"""

from __future__ import annotations

import re
from collections import Counter as Tally
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import fresh, let, settle

MAX_TOXIC, MAX_CLEAN = 1000, 3000
MAX_NEGATIVE, HARD_NEGATIVE, MAX_POSITIVE = 4000, 1500, 1200
LANDMARKS = 300
DECAY, ORDER, WINDOW, ALPHABET = 0.6, 3, 18, 64
ROUNDS = 2
RATE = 50  # a witness stands in toxic documents at least this many times as often as in clean ones
THRESHOLD = 0.7
TOXIC_SHARE = 1 / 3
TABLE_BITS = 20  # subsequences are hashed into the table; meetings are rare and harmless
MEMO = 400_000

_SENTENCE = re.compile(r"[.!?]+\s+|\n+")
_SPELLED = re.compile(r"(?:^|(?<=\s))\S(?:\s\S){2,}(?=\s|$)")
# Characters often written for letters.
_LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_GRIDS: dict[int, tuple] = {}


def words_of(text: str) -> list[str]:
    """Lower-case white-space words, and runs of three or more single characters joined."""
    low = text.lower()
    words = low.split()
    if _SPELLED.search(low):
        words += ["".join(m.group().split()) for m in _SPELLED.finditer(low)]
    return words


def _letters(word: str) -> list[int]:
    """A word's letters as codes, two marks before and one behind; punctuation in and around it is left out."""
    own = [1 + ord(c) - 97 if "a" <= c <= "z" else 28 + ord(c) % 36
           for c in word.translate(_LOOKALIKE) if c.isalnum()]
    return [0, 0, *own, 27]


def _windows(word: str) -> list[list[int]]:
    """A word's letters; long words as overlapping windows that cover all of it."""
    x = _letters(word)
    if len(x) <= WINDOW:
        return [x]
    half = WINDOW // 2
    return [x[i:i + WINDOW] for i in range(0, len(x) - half, half)]


def _grid(n: int):
    """Index triples of a word of n letters and their weights."""
    import numpy as np

    if n not in _GRIDS:
        at = np.array(list(combinations(range(n), ORDER)), "i4").reshape(-1, ORDER)
        _GRIDS[n] = (at, DECAY ** (at[:, -1] - at[:, 0] + 1.0))
    return _GRIDS[n]


def subsequences(rows):
    """For letter rows of one length: codes (rows x triples), their weights, and the kernel norms."""
    import numpy as np

    x = np.array(rows, "i4")
    at, weight = _grid(x.shape[1])
    codes = np.zeros((len(x), len(at)), "i8")
    for k in range(ORDER):
        codes = codes * ALPHABET + x[:, at[:, k]]
    codes = (codes * 2654435761 & 0xFFFFFFFF) >> (32 - TABLE_BITS)
    if not codes.shape[1]:
        return codes, weight, np.zeros(len(x))
    # equal subsequences of a row meet by sorting (row, code, span); the span gives the weight back
    span = at[:, -1] - at[:, 0] + 1
    row = np.arange(len(x), dtype="i8")[:, None] << TABLE_BITS
    keys = np.sort(((row + codes) << 5) + span, axis=1).ravel()
    groups = keys >> 5
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sums = np.add.reduceat((DECAY ** np.arange(32.0))[keys & 31], first)
    norm = np.bincount(groups[first] >> TABLE_BITS, weights=sums ** 2, minlength=len(x))
    return codes, weight, np.sqrt(norm)


def _by_length(words: list[str]):
    """(places in ``words``, letter rows) for each row length."""
    groups: dict[int, tuple[list, list]] = {}
    for i, w in enumerate(words):
        for x in _windows(w):
            g = groups.setdefault(len(x), ([], []))
            g[0].append(i)
            g[1].append(x)
    for places, rows in groups.values():
        for at in range(0, len(rows), 1000):
            yield places[at:at + 1000], rows[at:at + 1000]


@dataclass
class Model:
    """Weights of subsequences, bias, and the slopes and offset of the logistic curve."""
    table: object
    bias: float
    slopes: tuple[float, float] = (1.0, 0.0)
    offset: float = 0.0

    def margins(self, words: list[str]):
        """Margins of words; a long word's is that of its highest window."""
        import numpy as np

        out = np.full(len(words), -np.inf)
        for places, rows in _by_length(words):
            codes, weight, norm = subsequences(rows)
            dot = self.table[codes] @ weight if codes.shape[1] else np.zeros(len(rows))
            np.maximum.at(out, places, dot / np.maximum(norm, 1e-12) + self.bias)
        return out


class Scorer:
    """Margins of texts, with a bounded memo of words."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def texts(self, texts: list[str | None]):
        """The two highest word margins of each text, texts x 2; a few texts' words are held at a time."""
        import numpy as np

        parts = [self._few(texts[i:i + 128]) for i in range(0, len(texts), 128)]
        return np.concatenate(parts) if parts else np.zeros((0, 2))

    def _few(self, texts: list[str | None]):
        import numpy as np

        split = [words_of(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        new = list({w for one in split for w in one if w not in memo})
        memo.update(zip(new, self.model.margins(new).tolist()))
        out = np.full((len(texts), 2), self.model.bias)
        for i, one in enumerate(split):
            margins = list(map(memo.__getitem__, one))
            for k in range(min(2, len(margins))):
                out[i, k] = top = max(margins)
                margins.remove(top)
        return np.maximum(out, self.model.bias)


def kernel(words: list[str], landmarks: list[str]):
    """Normalized kernel values, words x landmarks (a long word: its best window)."""
    import numpy as np

    cols: dict[int, int] = {}
    own = [subsequences([_windows(w)[0]]) for w in landmarks]
    for codes, _, _ in own:
        for c in codes[0].tolist():
            cols.setdefault(c, len(cols))
    place = np.full((1 << TABLE_BITS), len(cols), "i4")
    place[list(cols)] = list(cols.values())
    table = np.zeros((len(cols) + 1, len(landmarks)), "f4")
    for j, (codes, weight, norm) in enumerate(own):
        np.add.at(table[:, j], place[codes[0]], weight / max(norm[0], 1e-12))
    out = np.zeros((len(words), len(landmarks)), "f4")
    for places, rows in _by_length(words):
        for at in range(0, len(rows), 200):
            codes, weight, norm = subsequences(rows[at:at + 200])
            got = np.einsum("ntm,t->nm", table[place[codes]], weight.astype("f4"))
            np.maximum.at(out, places[at:at + 200], got / np.maximum(norm, 1e-12)[:, None].astype("f4"))
    return out


def fit(positive: dict[str, float], negative: list[str], landmarks: list[str], ridge: float = 2e-5) -> Model:
    """A linear machine on Nystroem features, collapsed to subsequence weights. ``positive``: words and weights."""
    import numpy as np

    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype("f8"))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    x = np.vstack([kernel(list(positive), landmarks), kernel(negative, landmarks)]).astype("f8") @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    up = np.array(list(positive.values()), "f8")
    c = np.r_[0.5 * up / max(up.sum(), 1e-12), np.full(len(negative), 0.5 / max(len(negative), 1))]
    w, keep = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-9]
    for _ in range(25):  # Newton steps of the squared hinge
        inside = y * (x @ w) < 1
        xi, ci = x[inside], c[inside]
        new = np.linalg.solve(xi.T @ (xi * ci[:, None]) + np.diag(keep), xi.T @ (ci * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    alpha, table = root @ w[:-1], np.zeros((1 << TABLE_BITS))
    for a, word in zip(alpha, landmarks):
        codes, weight, norm = subsequences([_windows(word)[0]])
        np.add.at(table, codes[0], a * weight / max(norm[0], 1e-12))
    return Model(table, float(w[-1]))


def altered(words: list[str]) -> list[str]:
    """Each word with a letter inserted, one doubled, and one left out, at places that follow from the word."""
    out = []
    for w in words:
        if len(w) > 4:
            k = 1 + sum(map(ord, w)) % (len(w) - 2)
            out += [w[:k] + "x" + w[k:], w[:k] + w[k] + w[k:], w[:k] + w[k + 1:]]
    return out


def _curve(margin, y) -> tuple[list[float], float]:
    """Slopes and offset of a logistic curve over the two highest margins: damped Newton steps, with a
    weak pull of the slopes to 3. Toxic texts weigh ``TOXIC_SHARE`` together whatever the sample's
    shares are, so that scores mean the same for few and many labels."""
    import numpy as np

    up = (y > 0).sum()
    weight = np.where(y > 0, TOXIC_SHARE / max(up, 1), (1 - TOXIC_SHARE) / max(len(y) - up, 1))

    goal, pull = np.array([3.0, 3.0, -3.0]), np.array([2e-4, 2e-4, 1e-9])
    x, p = np.c_[margin, np.ones(len(margin))], goal.copy()

    def loss(p):
        return (weight * np.logaddexp(0, -y * (x @ p))).sum() + (pull * (p - goal) ** 2).sum() / 2

    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        grad = x.T @ (weight * (q - (y > 0))) + pull * (p - goal)
        hess = x.T @ (x * (weight * q * (1 - q))[:, None]) + np.diag(pull)
        step, size = np.linalg.solve(hess, grad), 1.0
        while loss(p - size * step) > loss(p) and size > 1e-6:
            size /= 2
        p = p - size * step
        if abs(size * step).max() < 1e-7:
            break
    return np.maximum(p[:2], 0.05).tolist(), float(p[2])


def _word_column(text: Column) -> Column:
    """Distinct words of a text's sentences, as ``words_of`` sees them."""
    import pandas as pd

    def split(texts):
        return texts.map(lambda t: sorted({w for s in _SENTENCE.split(t) for w in words_of(s) if len(w) > 2}))

    split.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(split, "array<string>")(F.coalesce(text, F.lit("")))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, toxic): the labelled documents training may see, within the bounds."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(
        F.col(key).alias("id")).agg(F.max("toxic").alias("toxic"))
    picked = None
    for toxic, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        some = marks.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(key).alias("i"), F.col(text).alias("text"))
    return texts.join(F.broadcast(picked), F.col("i") == F.col("id")).groupBy("text").agg(  # bounded above
        F.min("id").alias("id"), F.max("toxic").alias("toxic")).filter("text is not null")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """The machine, or None where the labels lack a class."""
    import numpy as np

    rows = settle(sample(docs, labels, key, text))
    words = settle(rows.select("id", "toxic", F.explode(_word_column(F.col("text"))).alias("word")))
    n = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    clean = settle(words.filter("toxic = 0").groupBy("word").agg(F.count("*").alias("n")))
    common = [r[0] for r in clean.orderBy(F.desc("n"), "word").limit(MAX_NEGATIVE // 4).collect()]
    others = [r[0] for r in clean.orderBy(F.xxhash64("word"), "word").limit(3 * MAX_NEGATIVE // 4).collect()]
    negative = sorted({*common, *others})
    # words whose rate in toxic documents is far above that in clean ones: candidates for witnesses
    told = words.filter("toxic = 1").groupBy("word").agg(F.count("*").alias("t")).join(clean, "word", "left").filter(
        F.coalesce("n", F.lit(0)) * RATE * n[1] <= F.col("t") * n[0]).select("word")
    odd = words.filter("toxic = 1").join(told, "word").select("id", "word")
    by_doc: dict[int, list[str]] = {}
    seen: dict[str, int] = {}
    for i, w in odd.orderBy("id", "word").collect():
        by_doc.setdefault(i, []).append(w)
        seen[w] = seen.get(w, 0) + 1
    if not seen:
        return None
    # over-represented: more often than any chance word would be, given the clean sample's size
    least = max(2, round(np.log(len(seen) + 1) / np.log((n[0] + n[1]) / n[1])))
    least = min(least, max(seen.values()))
    positive = sorted((w for w in seen if seen[w] >= least), key=lambda w: (-seen[w], w))
    positive = firm = positive[:MAX_POSITIVE]
    hard: list[str] = []
    negative = [w for w in negative if w not in seen]
    fair = settle(clean.join(told, "word", "left_anti"))
    for _ in range(ROUNDS):
        half = LANDMARKS // 2
        marks = list(dict.fromkeys(positive[:half] + hard[:half] + common[:half // 4]))
        weights = {w: float(np.sqrt(seen[w])) for w in positive}
        weights |= {a: 0.2 * weights[w] for w in positive[:half] for a in altered([w]) if a not in weights}
        model = fit(weights, negative, marks)
        hard = [r[0] for r in fair.select("word", _margin_column(F.col("word"), model).alias("m")).orderBy(
            F.desc("m"), "word").limit(HARD_NEGATIVE).collect()]
        negative = sorted({*negative, *hard})
        model = fit({w: v for w, v in weights.items() if w not in set(hard)}, negative, marks)
        margin = dict(zip(seen, model.margins(list(seen)).tolist()))
        witness = {max(ws, key=lambda w: (margin[w], w)) for ws in by_doc.values()}
        alike = [w for w in seen if margin[w] > 0 and (seen[w] > 1 or w in witness and margin[w] > 0.25)]
        # toxic documents without a witness yet: what is over-represented among them alone
        left = [ws for ws in by_doc.values() if max(margin[w] for w in ws) <= 0.25]
        again = Tally(w for ws in left for w in ws)
        least = max(2, round(np.log(len(again) + 1) / np.log((n[0] + len(left) + 1) / (len(left) + 1))))
        more = [w for w, k in again.items() if k >= least]
        positive = sorted({*firm, *alike, *more}, key=lambda w: (-seen[w], w))[:MAX_POSITIVE]
    pairs = rows.select("toxic", _text_margins(F.col("text"), model).alias("m")).collect()
    margins, y = np.array([list(r[1]) for r in pairs]), np.array([1 if r[0] else -1 for r in pairs])
    model.slopes, model.offset = _curve(margins, y)
    return model


def _margin_column(word: Column, model: Model) -> Column:
    import pandas as pd

    def many(words):
        import pandas as pd

        return pd.Series(model.margins(list(words)), dtype="float64")

    many.__annotations__ = {"words": pd.Series, "return": pd.Series}
    return pandas_udf(many, "double")(word)


def _text_margins(text: Column, model: Model) -> Column:
    import pandas as pd

    held = []

    def many(texts):
        if not held:
            held.append(Scorer(model))
        return pd.Series(held[0].texts(list(texts)).tolist())

    many.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(many, "array<double>")(F.coalesce(text, F.lit("")))


def toxicity(df: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from the threshold on)."""
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("score", "predicted")]
    if model is None:
        score = F.lit(0.0)
    else:
        score = let(_text_margins(F.col(text), model), lambda m: m[0] * model.slopes[0] + m[1] * model.slopes[1])
        score = 1 / (1 + F.exp(-F.least(F.greatest(score + model.offset, F.lit(-30.0)), F.lit(30.0))))
    raw = fresh(df, "tox_score")[0]
    out = df.select(*keep, score.alias(raw))
    return out.select(*keep, F.col(raw).alias("score"), (F.col(raw) >= threshold).cast("int").alias("predicted"))
