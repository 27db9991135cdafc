"""Language of texts: known words first, shorter and shorter character n-grams for the others.

The model holds log frequencies by language of words, and of n-grams of one to
four characters of words with their ends marked. A word of the model adds its
log frequencies; any other adds the mean of those of its known n-grams, of the
longest length of which it has one. It is counted by Spark from a bounded
sample of labelled documents, so it can be sent to all tasks.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
# Different labelled texts of a language that the model is counted from, at most, and how often it must have seen something.
SAMPLE = 1200
LEAST_WORD, LEAST_GRAM = 2, 3
LENGTHS = (4, 3, 2, 1)
# Words that a worker keeps the scores of, and words of a text that count as full evidence.
_KEPT, _FULL = 200_000, 20
_HASHES = 1 << 62
_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training; a null id is not, and trains nothing either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, may_train: Column, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from rows that may train and have a text and a language: of each language, the `sample` different texts of
    the smallest hashes, or all of fewer. Copies count once."""
    rows = docs.filter(may_train & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    mark = F.pmod(F.xxhash64("text", "lang"), F.lit(_HASHES))
    marks = rows.select("lang", mark.alias("mark")).distinct()
    sizes = {r[0]: r[1] for r in marks.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], {}, {})
    # Twice as many hashes as wanted and some more lie below these bounds, about; so the wanted ones do.
    bounds = {x: _HASHES if n <= 2 * sample + 100 else _HASHES * (2 * sample + 100) // n for x, n in sizes.items()}
    found: dict[str, list[int]] = {}
    for lang, own in marks.filter(F.col("mark") < _by_lang(bounds)).collect():
        found.setdefault(lang, []).append(own)
    last = {x: sorted(own)[:sample][-1] for x, own in found.items()}
    chosen = rows.filter(mark <= _by_lang(last)).distinct()
    words = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"))).alias("item"))
    words = words.groupBy("lang", "item").count()
    grams = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length("marked") - n + 1, F.lit(1))), lambda i, n=n: F.substring("marked", i, F.lit(n))
        )
        for n in LENGTHS
    ]
    parts = words.withColumn("marked", F.concat(F.lit("^"), "item", F.lit("$")))
    parts = parts.select("lang", "count", F.explode(F.concat(*grams)).alias("item")).groupBy("lang", "item").agg(F.sum("count").alias("count"))
    return Model(langs, _table(words, LEAST_WORD, langs), _table(parts, LEAST_GRAM, langs))


def _by_lang(values: dict[str, int]) -> Column:
    """The value of a row's language."""
    return F.element_at(F.create_map(*(x for lang, value in values.items() for x in (F.lit(lang), F.lit(value).cast("long")))), F.col("lang")).cast("long")


def _table(counts: DataFrame, least: int, langs: list[str]) -> dict[str, np.ndarray]:
    """Log frequencies by language of what was seen often enough."""
    wide = counts.groupBy("item").pivot("lang", langs).agg(F.sum("count")).fillna(0)
    names = [f"`{x.replace('`', '``')}`" for x in langs]
    seen = sum((F.col(x) for x in names[1:]), F.col(names[0]))
    rows = wide.filter(seen >= least).select("item", *names).toArrow()
    totals = [max(1, sum(rows.column(k + 1).to_pylist())) for k in range(len(langs))]
    table = np.stack([np.asarray(rows.column(k + 1), dtype=np.float64) for k in range(len(langs))], axis=1)
    logs = np.log((table + 0.5) / (np.array(totals) + 0.5 * len(table)))
    logs -= logs.mean(axis=1, keepdims=True)
    return dict(zip(rows.column(0).to_pylist(), logs.astype(np.float32)))


class Model:
    """Scores texts; see the module's text."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.langs, self.words, self.grams = langs, words, grams
        # Scores of words met so far lie in rows of one table.
        self._places: dict[str, int] = {}
        self._scores = np.zeros((1024, len(langs)))

    def word(self, word: str) -> np.ndarray:
        """Evidence of one word by language."""
        known = self.words.get(word)
        if known is not None:
            return known
        marked = f"^{word}$"
        for n in LENGTHS:
            found = [g for i in range(len(marked) - n + 1) if (g := self.grams.get(marked[i : i + n])) is not None]
            if found:
                return sum(found[1:], found[0]) / len(found)
        return np.zeros(len(self.langs), np.float32)

    def _place(self, word: str) -> int:
        """Where the scores of a word lie."""
        place = self._places.get(word)
        if place is None:
            place = len(self._places)
            if place == len(self._scores):
                self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
            self._scores[place] = self.word(word)
            self._places[word] = place
        return place

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability)."""
        found = Counter(_LETTERS.findall((text or "").lower()))
        words: Counter[str] = Counter()
        for run, n in found.items():
            # A run may hold signs that the pattern takes for letters, such as a raised two.
            for w in [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split():
                words[w] += n
        if not words or not self.langs:
            return UNKNOWN, 0.0
        if len(self._places) > _KEPT:
            self._places.clear()
        places = [self._place(w) for w in words]
        counts = np.fromiter(words.values(), np.float64, len(words))
        total = counts @ self._scores[places]
        total *= min(1.0, _FULL / counts.sum())
        best = int(total.argmax())
        return self.langs[best], 1.0 / math.fsum(np.exp(total - total[best]).tolist())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from the whole text and nothing else.

    A text that is null or has no letters gives `und` with score 0; so does any
    text where nothing could be learned. Languages that tie go by their names.
    """
    # Pickled with the code of its class, as executors need not have this package.
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            found = [own.predict(x.as_py()) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return source.mapInArrow(read, "doc_id long, held_out boolean, lang_pred string, score double")
