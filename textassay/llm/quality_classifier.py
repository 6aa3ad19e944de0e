"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on a text (numpy, over the whole text). Their accuracies are
estimated by expectation-maximisation without any label: the votes of a text are independent given its
true class, and each labeller has a table of how often it casts each vote for each class. A prior table says what is
expected of a heuristic: it hardly ever calls a good text bad, and may well miss a bad one. EM runs on the counts
of vote patterns over all texts, which are at most 3^labellers rows however large the corpus is. The posterior of a text's pattern is its soft label.

A hashed linear scorer is then trained on the posteriors of a bounded sample (``SAMPLE`` texts by hash of the id) and
scores every text. Its features are the shares of hashed byte trigrams of the whole text, digits, upper and
lower case letters and non-ASCII bytes folded to classes in half of them, so that it learns form and not topic.

Defined cases: null and empty texts get no vote, the prior as posterior, and the score of a text without
features; ties and repeated rows have equal results; an empty table gives an empty table. Columns other than id and text are not
read; gold labels are never read.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import materialize, whole

GOOD, BAD, ABSTAIN = 1, 0, 2
FEATURES = 4096
SAMPLE = 6_000
ROUNDS = 300
KEEP_FROM = 0.5
BLOCK = 1 << 20
LABELLERS = ("symbols", "capitals", "shouting", "tables", "variety", "sentences", "word_length", "letters")
# Expected shares of the votes bad, good, abstain for bad and for good texts, and how much they weigh against the data.
EXPECTED = np.array([[0.15, 0.70, 0.15], [0.001, 0.849, 0.15]])
TRUST = 2.0


def _kinds(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in characters])


_SYMBOLS, _STOPS, _BLANKS = _kinds("#$%&*@^~_=+<>{}[]\\/|"), _kinds(".!?"), _kinds(" \t\n\x0b\x0c\r")
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def votes(text: str) -> str:
    """One digit per labeller, in their order; all abstain on a text without a word."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    blank = _BLANKS[raw]
    words = int((~blank).sum() and (np.diff(np.append(True, blank).view(np.int8)) == -1).sum())
    if not words:
        return str(ABSTAIN) * len(LABELLERS)
    tokens = text.lower().split() or [text]
    variety = len(set(tokens)) / len(tokens)
    symbols, stops, bangs, bars = (counts[k].sum() / words for k in (_SYMBOLS, _STOPS, 33, 124))
    upper, lower = counts[_UPPER].sum(), counts[_LOWER].sum()
    foreign = counts[0xC0:].sum()  # lead bytes of other letters
    letters = (upper + lower + foreign) / max(len(text) - counts[_BLANKS].sum(), 1)
    length = len(text) / words
    tests = (
        (symbols < 0.1, symbols > 0.35),
        (upper < 0.4 * (upper + lower), upper > 0.7 * (upper + lower) and words > 4),
        (bangs < 0.1, bangs > 0.4),
        (bars < 0.05, bars > 0.3),
        (words >= 30 and variety > 0.4, words >= 30 and variety < 0.2),
        (words >= 8 and 0.02 <= stops <= 0.35, words >= 60 and stops < 0.002),
        (3.0 <= length <= 14.0, length > 40.0),
        (letters > 0.75, letters < 0.5),
    )
    return "".join(str(BAD if bad else GOOD if good else ABSTAIN) for good, bad in tests)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, trust: float = TRUST) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good texts, tables [labeller, class, vote], posterior of good for each pattern) by EM."""
    n, labels = patterns.shape
    if not n:
        return 0.5, np.full((labels, 2, 3), 1 / 3), np.zeros(0)
    # Starts from the balance of votes: a labeller is expected to be right more often than not.
    balance = (patterns == GOOD).sum(axis=1) - 2.0 * (patterns == BAD).sum(axis=1)
    good = 1 / (1 + np.exp(-np.clip(balance, -20, 20)))
    one_hot = np.stack([patterns == v for v in (BAD, GOOD, ABSTAIN)], axis=2).astype(float)
    prior, tables = 0.5, np.zeros((labels, 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts], axis=1)
        tables = np.einsum("pc,plv->lcv", weight, one_hot) + trust * weight.sum(axis=0)[None, :, None] * EXPECTED + EXPECTED
        tables /= tables.sum(axis=2, keepdims=True)
        prior = float((weight[:, 1].sum() + 1) / (counts.sum() + 2))
        log = np.einsum("plv,lcv->pc", one_hot, np.log(tables)) + np.log([1 - prior, prior])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return prior, tables, good


_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[48:58], _CLASSES[65:91], _CLASSES[97:123], _CLASSES[128:] = 48, 65, 97, 97


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed byte-trigram counts."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(FEATURES, np.int64)
    half = FEATURES // 2
    for i in range(0, len(raw), BLOCK):
        part = raw[max(0, i - 2) : i + BLOCK]
        for shift, values in ((0, part), (half, _CLASSES[part])):
            v = values.astype(np.uint32)
            grams = (v[:-2] << np.uint32(16)) | (v[1:-1] << np.uint32(8)) | v[2:] if len(v) > 2 else v
            hashed = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - half.bit_length() + 1)
            counts[shift : shift + half] += np.bincount(hashed, minlength=half)
    out = np.sqrt(counts)
    return (out / max(float(np.linalg.norm(out)), 1e-9)).astype(np.float32)


def fit_scorer(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic scorer for soft labels, both classes weighing alike."""
    w, b = np.zeros(FEATURES, np.float32), np.float32(0)
    if not len(x):
        return w, b
    y = y.astype(np.float32)
    weight = np.where(y > 0.5, 0.5 / max((y > 0.5).sum(), 1), 0.5 / max((y <= 0.5).sum(), 1)).astype(np.float32)
    m, speed = np.zeros(FEATURES + 1, np.float32), np.zeros(FEATURES + 1, np.float32)
    for step in range(1, ROUNDS + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y) * weight
        gradient = np.append(error @ x + np.float32(1e-5) * w, error.sum()).astype(np.float32)
        m, speed = 0.9 * m + 0.1 * gradient, 0.99 * speed + 0.01 * gradient**2
        change = 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-8)
        w, b = (w - change[:-1]).astype(np.float32), np.float32(b - change[-1])
    return w, float(b)


def score_udf(w: np.ndarray, b: float):
    @pandas_udf("votes string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        marks = [float(1 / (1 + np.exp(-np.clip(features(t) @ w + b, -50, 50)))) for t in texts]
        return pd.DataFrame({"votes": [votes(t) for t in texts], "score": np.array(marks, float)})

    return score


def vote_udf():
    @pandas_udf("string")
    def vote(texts: pd.Series) -> pd.Series:
        return pd.Series([votes(t) for t in texts], dtype=object)

    return vote


def score_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, votes, posterior, score, keep), one row per row; votes in the order of LABELLERS. Runs jobs when called."""
    rows = df.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    turn = F.xxhash64("doc_id", F.length("text"))
    narrow = materialize(rows.select("doc_id", turn.alias("turn"), vote_udf()("text").alias("votes")), "quality-votes")
    found = narrow.groupBy("votes").count().collect()  # at most 3^labellers rows
    patterns = np.array([[int(v) for v in r["votes"]] for r in found], int).reshape(len(found), len(LABELLERS))
    _, _, good = fit_votes(patterns, np.array([r["count"] for r in found], float))
    belief = dict(zip([r["votes"] for r in found], good.tolist(), strict=True))
    # The bounded sample to train on: the rows whose hash is below that of the SAMPLE-th.
    last = narrow.select("turn").orderBy("turn").limit(SAMPLE).agg(F.max("turn")).first()[0]
    taught = rows.where(turn <= F.lit(last)) if last is not None else rows
    taught = taught.limit(2 * SAMPLE).mapInPandas(_examples, "x binary, votes string").toPandas()
    x = np.array([np.frombuffer(v, np.float32) for v in taught["x"]]).reshape(len(taught), FEATURES)
    w, b = fit_scorer(x, np.array([belief.get(v, 0.5) for v in taught["votes"]]))
    posterior = df.sparkSession.createDataFrame(list(belief.items()), "votes string, posterior double")
    scored = rows.withColumn("said", score_udf(w, b)("text")).select("doc_id", "said.votes", "said.score").join(F.broadcast(posterior), "votes")
    return scored.select("doc_id", "votes", "posterior", "score", (F.col("score") >= KEEP_FROM).alias("keep"))


def _examples(batches):
    for batch in batches:
        yield pd.DataFrame({"x": [features(t).tobytes() for t in batch["text"]], "votes": [votes(t) for t in batch["text"]]})
