"""Language identification by interpolated Kneser-Ney character models.

One model for each language, of order ORDER over lower-cased letters, every run of other characters being
one blank. All training texts are counted: each task counts the longest grams of its rows, Spark adds
them up by language and gram, and the continuation counts of the shorter orders are counts of distinct
longer grams. Grams are held as sorted arrays of hashes below 2 ** HASH_BITS, one row of numbers by
language; so the model that is gathered and broadcast is bounded by the number of hashes, orders and
languages, whatever the corpus. Language of a text: the model with the lowest cross-entropy per gram.

Calibration, on all training rows, of which tasks gather sums only: the factor that turns
cross-entropies into probabilities, and for each language the cross-entropy of its own texts. A text
is rejected if it has no letters, or its best cross-entropy lies above what is usual for that language
by REJECT_SIGMAS deviations at that length and by REJECT_MARGIN, which texts of mixed language stay below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import in_pieces, in_tasks
from leaguelake.llm.shingles import mix
from leaguelake.sources.store import cut

ORDER = 4
HASH_BITS = 22
REJECT_SIGMAS = 8.0
REJECT_MARGIN = 1.5
#: Variance of the mean of n grams, times n; neighbouring grams are alike, so more than that of one.
PER_GRAM = 6.0
UNDECIDED = "und"
#: Characters of one text worked on at a time, and grams counted before they are summed up.
BLOCK = 1 << 18
COUNTED = 1 << 21
#: Tried when probabilities are fitted.
SHARPNESSES = np.geomspace(0.5, 200, 40)
#: A language's usual cross-entropy is that of its texts of so many grams, if there are so many of them.
USUAL_GRAMS, USUAL_TEXTS = 200, 20
#: Fractions that calibration sums are counted in: of cross-entropies, and of losses, which may all but vanish.
UNITS, LOSS_UNITS = 1 << 40, 1 << 60
#: Beyond any distance of cross-entropies, but finite.
FAR = 1000.0
_BITS = 16
_BLANK = 0x20


@cache
def _letters() -> np.ndarray:
    """Code point to symbol: letters stay, all else is a blank."""
    return np.array([c if chr(c).isalpha() else _BLANK for c in range(1 << 16)], np.uint16)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _letters()[points & 0xFFFF]
    if len(points) and points.max() >= 1 << 16:
        for p in np.unique(points[points >= 1 << 16]):
            # letters beyond 16 bits share the codes of surrogates, which are no letters
            found[points == p] = 0xD800 + int(p) % 2048 if chr(int(p)).isalpha() else _BLANK
    blank = found == _BLANK
    return found[~(blank & np.concatenate([[True], blank[:-1]]))]


def grams(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Blocks of (grams of ORDER symbols, 16 bits each, one for each symbol; number of letters)."""
    before = np.full(ORDER - 1, _BLANK, np.uint64)
    for start in range(0, len(text), BLOCK):
        own = symbols(text[start : start + BLOCK])
        padded = np.concatenate([before, own.astype(np.uint64)])
        keys = np.zeros(len(own), np.uint64)
        for i in range(ORDER):
            keys = (keys << np.uint64(_BITS)) | padded[i : len(padded) - ORDER + 1 + i]
        before = padded[len(padded) - ORDER + 1 :]
        yield keys, int((own != _BLANK).sum())


def slots(order: int, keys: np.ndarray) -> np.ndarray:
    salt = np.uint64(order * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(keys + salt) >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << (_BITS * order)) - 1)


# -- counting ------------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}

    def add(lang: str) -> None:
        keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
        if lang in sums:
            both = np.concatenate([sums[lang][0], keys])
            keys, at = np.unique(both, return_inverse=True)
            n = np.bincount(at, np.concatenate([sums[lang][1], n]), len(keys)).astype(np.int64)
        sums[lang] = keys, n

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for keys, letters in grams(text.as_py()):
                if letters:
                    waiting.setdefault(lang, []).append(keys)
            if lang in waiting and sum(map(len, waiting[lang])) > COUNTED:
                add(lang)
    for lang in list(waiting):
        add(lang)
    for lang, (keys, n) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())],
            ["lang", "gram", "n"],
        )


def _with_slots(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("gram").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"), batch.column("n"), pa.array(slots(order, keys)),
                pa.array(slots(order - 1, keys >> np.uint64(_BITS)) if order > 1 else np.zeros(len(keys), np.int32)),
                pa.array(slots(order - 1, _suffix(keys, order - 1)) if order > 1 else np.zeros(len(keys), np.int32)),
            ],
            ["lang", "n", "slot", "context", "suffix"],
        )


def _low_bits(gram: str, order: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (_BITS * order)) - 1))


# -- the model -----------------------------------------------------------------------------------


@dataclass
class Order:
    """Of one order: sorted gram hashes with their probability by language, and sorted context
    hashes with the weight by language that a gram unseen after them gives to the order below."""

    slots: np.ndarray
    probability: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray


@dataclass
class LanguageModel:
    languages: list[str]
    orders: list[Order]
    unseen: float
    sharpness: float = 1.0
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None

    def probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.unseen, np.float32)
        own, wanted = self.orders[order - 1], slots(order, keys)
        at = np.minimum(np.searchsorted(own.slots, wanted), len(own.slots) - 1)
        found = own.probability[at]
        missing = np.flatnonzero(own.slots[at] != wanted)
        if len(missing):
            rest = keys[missing]
            context = slots(order - 1, rest >> np.uint64(_BITS)) if order > 1 else np.zeros(len(rest), np.int32)
            there = np.minimum(np.searchsorted(own.contexts, context), len(own.contexts) - 1)
            known = (own.contexts[there] == context)[:, None]
            below = self.probabilities(_suffix(rest, order - 1), order - 1)
            found[missing] = np.where(known, own.weight[there], np.float32(1)) * below
        return found

    def score(self, text: str) -> tuple[np.ndarray, int, int]:
        """Cross-entropy by language, number of grams, number of letters."""
        total, n, letters = np.zeros(len(self.languages)), 0, 0
        for keys, some in grams(text):
            total -= np.log(self.probabilities(keys)).sum(axis=0, dtype=np.float64)
            n += len(keys)
            letters += some
        return total / max(n, 1), n, letters

    def verdict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, probability, its cross-entropy, and whether it is rejected."""
        if not text or not self.languages:
            return UNDECIDED, 0.0, 0.0, True
        entropy, n, letters = self.score(text)
        if not letters:
            return UNDECIDED, 0.0, 0.0, True
        best = int(entropy.argmin())
        weights = np.exp(-self.sharpness * (entropy - entropy[best]))
        limit = np.inf
        if self.usual is not None:
            strays = REJECT_SIGMAS * np.sqrt(self.spread[best] + PER_GRAM / n)
            limit = self.usual[best] + max(REJECT_MARGIN, strays)
        return self.languages[best], float(1 / weights.sum()), float(entropy[best]), bool(entropy[best] > limit)


def _order(found: pa.Table, contexts: pa.Table, languages: list[str], below: Order | None, unseen: float) -> Order:
    """Interpolates one order with the one below. Counts of hashes that collide are added."""
    at = {lang: i for i, lang in enumerate(languages)}

    def column(table: pa.Table, name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    def spread(table: pa.Table, keys: np.ndarray, name: str) -> np.ndarray:
        out = np.zeros((len(keys), len(languages)))
        langs = np.array([at[x] for x in table.column("lang").to_pylist()], np.int64)
        np.add.at(out, (np.searchsorted(keys, column(table, table.column_names[1])), langs), column(table, name))
        return out

    own, where = np.unique(column(found, "slot"), return_index=True)
    counts = spread(found, own, "n")
    known = np.unique(column(contexts, "context"))
    totals, kinds = spread(contexts, known, "total"), spread(contexts, known, "kinds")
    once, twice = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
    discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
    discount = np.clip(discount, 0.05, 0.95)
    weight = np.where(totals > 0, discount * kinds / np.maximum(totals, 1), 1.0)
    in_context = np.searchsorted(known, column(found, "context")[where])
    if below is None:
        lower = np.full(counts.shape, unseen)
    else:
        lower = below.probability[np.searchsorted(below.slots, column(found, "suffix")[where])]
    total = totals[in_context]
    seen = np.where(total > 0, np.maximum(counts - discount, 0) / np.maximum(total, 1), 0.0)
    probability = np.minimum(seen + weight[in_context] * lower, 1.0)
    return Order(own, probability.astype(np.float32), known, np.minimum(weight, 1.0).astype(np.float32))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts every row of docs that has a text and a language; then calibrates on all of them."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null and text <> ''"
    )
    counted = in_tasks(rows, _counted, "lang string, gram bigint, n bigint")
    level = cut(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    languages = sorted(r.lang for r in level.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], [], 1.0)
    levels = {ORDER: level}
    for order in range(ORDER - 1, 0, -1):
        level = level.select("lang", _low_bits("gram", order).alias("gram")).groupBy("lang", "gram").agg(
            F.count("*").alias("n")
        )
        levels[order] = level
    symbols_seen = levels[1].select("gram").distinct().count()
    unseen, orders, below = 1.0 / (symbols_seen + 1), [], None
    for order in range(1, ORDER + 1):
        placed = cut(
            in_tasks(
                levels[order], partial(_with_slots, order=order),
                "lang string, n bigint, slot int, context int, suffix int",
            ),
            "slots",
        )
        found = placed.groupBy("lang", "slot").agg(
            F.sum("n").alias("n"), F.min("context").alias("context"), F.min("suffix").alias("suffix")
        )
        contexts = placed.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        below = _order(found.toArrow(), contexts.toArrow(), languages, below, unseen)
        orders.append(below)
    model = LanguageModel(languages, orders, unseen)
    _calibrate(model, rows)
    return model


def _measured(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Sums over a task's texts, in whole units so that their order does not matter: the loss at every
    sharpness, and by language the number, cross-entropies and their squares of long texts told rightly."""
    scorer = model.value
    at = {lang: i for i, lang in enumerate(scorer.languages)}
    loss = [0] * len(SHARPNESSES)
    usual = [[0, 0, 0] for _ in scorer.languages]
    for batch in in_pieces(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            entropy, n, letters = scorer.score(text.as_py())
            if not letters or lang not in at:
                continue
            best, own = entropy.min(), at[lang]
            if not np.isfinite(best):
                continue
            above = np.minimum(entropy - best, FAR)
            each = SHARPNESSES * above[own] + np.log(np.exp(-np.outer(SHARPNESSES, above)).sum(axis=1))
            loss = [total + int(x * LOSS_UNITS) for total, x in zip(loss, each.tolist(), strict=True)]
            if above[own] == 0 and n >= USUAL_GRAMS:
                whole = round(float(best) * UNITS)
                for i, value in enumerate((1, whole, whole * whole)):
                    usual[own][i] += value
    found = [(-1, i, v) for i, v in enumerate(loss)]
    found += [(lang, i, v) for lang, sums in enumerate(usual) if sums[0] for i, v in enumerate(sums)]
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.decimal128(38, 0)), strict=True)],
        ["lang", "item", "total"],
    )


def _calibrate(model: LanguageModel, rows: DataFrame) -> None:
    """Every row counts. What is gathered has a size fixed by the languages."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    measured = in_tasks(rows, partial(_measured, model=shared), "lang int, item int, total decimal(38, 0)")
    totals = measured.groupBy("lang", "item").agg(F.sum("total").alias("total")).collect()
    shared.unpersist()
    sums = {(r.lang, r.item): int(r.total) for r in totals}
    if not any(sums.values()):
        return
    model.sharpness = float(min(enumerate(SHARPNESSES), key=lambda s: sums[-1, s[0]])[1])
    model.usual = np.full(len(model.languages), np.inf)
    model.spread = np.zeros(len(model.languages))
    for i in range(len(model.languages)):
        n, total, squares = (sums.get((i, item), 0) for item in range(3))
        if n >= USUAL_TEXTS:
            variance = (n * squares - total * total) / (n * n * UNITS * UNITS)
            model.usual[i], model.spread[i] = total / (n * UNITS), max(variance, 1e-4)


# -- use -----------------------------------------------------------------------------------------


def _identified(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    judge = model.value.verdict
    for batch in in_pieces(batches):
        found = [judge(text.as_py()) for text in batch.column("text")]
        columns = list(zip(*found, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"),
             *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            [*(c for c in batch.schema.names if c != "text"), "lang_pred", "score", "entropy", "rejected"],
        )


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (0 to 1), entropy, rejected of every row.

    Null texts and texts without letters are `und`, score 0, rejected; so is every text if nothing was
    learned. Rows are judged alone, by their whole text: null or repeated ids do not matter, and other
    columns, whatever their names, are not read. Of equal entropies the first language by name wins.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return in_tasks(
        rows, partial(_identified, model=shared),
        f"id {dict(rows.dtypes)['id']}, lang_pred string, score double, entropy double, rejected boolean",
    )


def _accepted(batches: Iterator[pa.RecordBatch], model, text_col: str) -> Iterator[pa.RecordBatch]:
    judge = model.value.verdict
    for batch in in_pieces(batches):
        keep = [not judge(text.as_py())[3] for text in batch.column(text_col)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def accepted_documents(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = partial(_accepted, model=shared, text_col=text_col)
    return in_tasks(docs, kept, docs.schema)
