"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents, so tokens are labelled first: over all labelled texts, counted once each, the
documents that hold a feature (a word or one of its first 3 to 6 letters) are counted by label, in
hashed slots that bound what is gathered. A token of a toxic text is labelled if one of its features is
tied to toxic texts by likelihood ratio and by odds. The field is fitted on windows of tokens from
a sample bounded by SAMPLE_ROWS of each label; a document's score is a logistic function of its highest
marginal and of the number of tokens likely toxic, fitted on the same number of whole documents.

Scoring is by whole texts: forward-backward over all tokens. Offsets are those of the tokens whose
marginal is at least one half, in code points.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm import crf
from leaguelake.llm.common import grown, in_pieces, in_tasks
from leaguelake.sources.store import cut

SAMPLE_ROWS = 3_000
WINDOW = 200
SLOTS = 1 << 18
PREFIXES = (3, 4, 5, 6)
#: Features that may come to mark toxic tokens by chance, and the log odds that a mark needs.
CHANCE_MARKS = 20
LOG_ODDS = 2.5
#: Distinct words that a worker remembers.
CACHE_WORDS = 200_000
#: Texts held as objects at a time.
ROWS = 1024
#: Tokens scored at a time, one document at least.
TOKENS = 1 << 18

_words = re.compile(r"\w+").findall


def tokens(text: str) -> list[str]:
    return _words(text.lower())


def features(word: str) -> list[int]:
    """Slots of the word and of its prefixes; a word too short for a prefix repeats itself."""
    whole = zlib.crc32(word.encode("utf-8", "replace")) % SLOTS
    starts = (f"{n}^{word[:n]}" if len(word) >= n else None for n in PREFIXES)
    return [whole, *(whole if s is None else zlib.crc32(s.encode("utf-8", "replace")) % SLOTS for s in starts)]


# -- labels of tokens ----------------------------------------------------------------------------


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Each distinct labelled text once (text, toxic); of differing labels the higher counts.

    Ids and hashes meet the labels first, and whole texts move only to the ids chosen there.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text <> ''")
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).where(
        "id is not null and toxic is not null"
    ).groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    hashes = rows.select("id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("k"))
    chosen = hashes.join(grown(marks), "id").groupBy("h", "k").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))
    chosen = cut(chosen.select("id", "h", "k", "toxic"), "labelled-ids")
    wanted = grown(chosen.select("id", "h", "toxic"))
    found = rows.withColumn("h", F.xxhash64("text")).join(wanted, ["id", "h"])
    return cut(found.select("text", "toxic"), "labelled")


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SLOTS), np.int64)
    known: dict[str, array] = {}
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            if len(known) > CACHE_WORDS:
                known.clear()
            slots: set[int] = set()
            for word in set(tokens(text.as_py())):
                if (found := known.get(word)) is None:
                    found = known[word] = array("l", features(word))
                slots.update(found)
            counts[toxic, list(slots)] += 1
    slots = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots), pa.array(counts[1, slots]), pa.array(counts[0, slots])], ["slot", "toxic", "clean"]
    )


def toxic_slots(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Which features are tied to toxic documents, by a likelihood ratio that few reach by chance.

    Chance gives a ratio of t to some exp(-t / 2) of the features.
    """
    n = n_toxic + n_clean
    held = toxic + clean

    def term(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    ratio = 2 * (
        term(toxic, held * n_toxic / n) + term(clean, held * n_clean / n)
        + term(n_toxic - toxic, (n - held) * n_toxic / n) + term(n_clean - clean, (n - held) * n_clean / n)
    )
    log_odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    needed = 2 * np.log(max((held > 0).sum() / CHANCE_MARKS, 1.0))
    return (ratio >= needed) & (log_odds >= LOG_ODDS)


def _windows(batches: Iterator[pa.RecordBatch], toxic_at) -> Iterator[pa.RecordBatch]:
    marked = toxic_at.value
    for batch in batches:
        out = []
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            words = tokens(text.as_py())
            if not words:
                continue
            labels = [int(bool(toxic) and bool(marked[features(w)].any())) for w in words] if toxic else None
            if labels and not any(labels):
                continue
            first = labels.index(1) if labels else zlib.crc32(words[0].encode("utf-8", "replace")) % len(words)
            start = max(0, min(first - WINDOW // 4, len(words) - WINDOW))
            piece = slice(start, start + WINDOW)
            out.append((words[piece], labels[piece] if labels else [0] * len(words[piece])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in out], pa.list_(pa.string())), pa.array([y for _, y in out], pa.list_(pa.int32()))],
            ["words", "labels"],
        )


# -- the model -----------------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    """A fitted field with the logistic function over it; without a field, the share of toxic labels."""

    field: crf.Field | None
    share: float
    logistic: np.ndarray | None = None


class Tagger:
    """Scores tokens of whole texts, remembering the words it has met."""

    def __init__(self, field: crf.Field) -> None:
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.own = array("d")
        self.whole = array("q")

    def _number(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            for word in set(words).difference(known):
                slots = features(word)
                known[word] = len(self.own)
                self.own.append(float(self.field.own[slots].sum()))
                self.whole.append(slots[0])
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The probability that each token is toxic, for each list of tokens."""
        if len(self.known) > CACHE_WORDS:
            self.forget()
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        chains = crf.Chains(lengths)
        total = int(lengths.sum())
        if not total:
            return [np.empty(0)] * len(texts)
        words = np.concatenate([self._number(texts[i]) for i in order])
        own, whole = np.array(self.own), np.array(self.whole)
        scores = own[words] + self.field.bias
        follows = np.ones(total, bool)
        follows[chains.starts[lengths > 0]] = False
        after = np.flatnonzero(follows)
        scores[after] += self.field.before[whole[words[after - 1]]]
        scores[after - 1] += self.field.after[whole[words[after]]]
        p = crf.marginals(scores, self.field.between, chains)
        found: list[np.ndarray] = [np.empty(0)] * len(texts)
        for i, start, n in zip(order, chains.starts, lengths, strict=True):
            found[i] = p[start : start + n]
        return found

    def summaries(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Tokens and marginals of each text, worked on in groups of bounded size."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(tokens(text))
            size += len(group[-1])
            if size >= TOKENS:
                yield from zip(group, self.marginals(group), strict=True)
                group, size = [], 0
        yield from zip(group, self.marginals(group), strict=True)


def _signs(p: np.ndarray) -> tuple[float, float]:
    """What the logistic function sees of a document: highest marginal (as log odds), likely tokens."""
    if not len(p):
        return -8.0, 0.0
    top = float(np.clip(p.max(), 1e-6, 1 - 1e-6))
    return float(np.clip(np.log(top / (1 - top)), -8, 8)), float(np.log1p(p[p >= 0.5].sum()))


def _logistic(weights: np.ndarray, signs: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + signs @ weights[1:], -30, 30)))


def _fit_logistic(signs: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(signs)), signs])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.1 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(curve, slope), -4, 4)
    return w


def _signs_of(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    tagger = Tagger(shared.value.field)
    for batch in in_pieces(batches, ROWS):
        texts = [t.as_py() for t in batch.column("text")]
        found = [_signs(p) for _, p in tagger.summaries(texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array([a for a, _ in found], pa.float64()), pa.array([b for _, b in found], pa.float64())],
            ["toxic", "top", "likely"],
        )


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """Learns from the rows of docs that `labels` (id_col, label_col) marks with 0 or more than 0."""
    context = docs.sparkSession.sparkContext
    rows = labelled_texts(docs, labels, id_col, text_col, label_col)
    numbers = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = numbers.get(0, 0), numbers.get(1, 0)
    share = n_toxic / max(n_toxic + n_clean, 1)
    if not n_clean or not n_toxic:
        return ToxicityModel(None, share)
    counted = in_tasks(rows, _feature_counts, "slot bigint, toxic bigint, clean bigint")
    counts = counted.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    toxic, clean = np.zeros(SLOTS), np.zeros(SLOTS)
    toxic[counts.column("slot").to_numpy()] = counts.column("toxic").to_numpy()
    clean[counts.column("slot").to_numpy()] = counts.column("clean").to_numpy()
    marked = toxic_slots(toxic, clean, n_toxic, n_clean)

    draw = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 20))
    parts = {label: min(1.0, SAMPLE_ROWS / n) for label, n in ((0, n_clean), (1, n_toxic))}
    limit = F.when(F.col("toxic") == 1, parts[1] * (1 << 20)).otherwise(parts[0] * (1 << 20))
    sample = rows.where(draw < limit)
    shared = context.broadcast(marked)
    windows = in_tasks(sample, partial(_windows, toxic_at=shared), "words array<string>, labels array<int>").toArrow()
    shared.unpersist()
    field = _fit_field(windows.column("words").to_pylist(), windows.column("labels").to_pylist())
    if field is None:
        return ToxicityModel(None, share)
    model = ToxicityModel(field, share)
    shared = context.broadcast(model)
    signs = in_tasks(sample, partial(_signs_of, shared=shared), "toxic int, top double, likely double").toArrow()
    shared.unpersist()
    y = signs.column("toxic").to_numpy().astype(float)
    x = np.column_stack([signs.column("top").to_numpy(), signs.column("likely").to_numpy()])
    model.logistic = _fit_logistic(x, y, np.where(y > 0, 1 / parts[1], 1 / parts[0]) * min(parts.values()))
    return model


def _fit_field(windows: list[list[str]], labels: list[list[int]]) -> crf.Field | None:
    if not any(any(one) for one in labels):
        return None
    order = sorted(range(len(windows)), key=lambda i: (-len(windows[i]), windows[i]))
    flat = [w for i in order for w in windows[i]]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    table = np.array([features(w) for w in number], np.int64)
    words = np.array([number[w] for w in flat], np.int64)
    y = np.array([v for i in order for v in labels[i]], np.int64)
    return crf.fit(table, words, y, crf.Chains(np.array([len(windows[i]) for i in order], np.int64)), SLOTS)


# -- use -----------------------------------------------------------------------------------------


def _scores(model: ToxicityModel, tagger: Tagger | None, texts: list[str]) -> Iterator[tuple[float, list[str], np.ndarray]]:
    if tagger is None:
        yield from ((model.share, [], np.empty(0)) for _ in texts)
    else:
        for words, p in tagger.summaries(texts):
            yield float(_logistic(model.logistic, np.array(_signs(p)))), words, p


def _spans(text: str, words: list[str], p: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each offending token. Lower-casing may change lengths, so the text is matched anew."""
    if not len(p) or p.max() < 0.5:
        return []
    places = [m.span() for m in re.finditer(r"\w+", text)]
    if len(places) != len(words):  # lower-casing has split or joined a token: offsets in the lower-cased text
        places = [m.span() for m in re.finditer(r"\w+", text.lower())]
    return [places[i] for i in np.flatnonzero(p >= 0.5)]


def _judged(batches: Iterator[pa.RecordBatch], shared, spans: bool) -> Iterator[pa.RecordBatch]:
    model = shared.value
    tagger = Tagger(model.field) if model.field else None
    for batch in in_pieces(batches, ROWS):
        texts = [t.as_py() or "" for t in batch.column("text")]
        scores, places = [], []
        for text, (score, words, p) in zip(texts, _scores(model, tagger, texts), strict=True):
            scores.append(score)
            if spans:
                places.append([{"start": a, "end": b} for a, b in _spans(text, words, p)])
        columns, names = [batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"]
        if spans:
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns, names = [*columns, pa.array(places, kind)], [*names, "spans"]
        yield pa.RecordBatch.from_arrays(columns, names)


def scored(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", spans: bool = True
) -> DataFrame:
    """id, score and, if asked for, spans (array of start, end) of every row.

    Null and empty texts score as texts without any likely token. Rows are judged alone, so null or repeated ids do not
    matter, and other columns, whatever their names, are not read. If either label was never seen, every score
    is the share of toxic labels, 0 without labels.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"id {dict(rows.dtypes)['id']}, score double"
    schema += ", spans array<struct<start:int,end:int>>" if spans else ""
    return in_tasks(rows, partial(_judged, shared=shared, spans=spans), schema)


def _clean(batches: Iterator[pa.RecordBatch], shared, text_col: str) -> Iterator[pa.RecordBatch]:
    model = shared.value
    tagger = Tagger(model.field) if model.field else None
    for batch in in_pieces(batches, ROWS):
        texts = [t.as_py() or "" for t in batch.column(text_col)]
        keep = [score < 0.5 for score, _, _ in _scores(model, tagger, texts)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def clean_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The documents that score below one half, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return in_tasks(docs, partial(_clean, shared=shared, text_col=text_col), docs.schema)
