"""Language identification by multilingual mixture inference.

Training counts, for each language, the character n-grams (see ``ngrams``) of all words of all its
training documents; the tables are sums over tasks, one number per language and bucket. A word's
likelihood in a language is the product of its n-grams' smoothed shares, with as many factors as the
word has places. A document is a mixture: each word comes from one of its languages, and
expectation-maximisation estimates the proportions. The set of languages starts with all; the one of
least proportion goes as long as the likelihood, less a penalty of half the logarithm of the number
of words for every language, does not fall. The language of largest proportion is the prediction,
its proportion the score. All documents of a batch are estimated side by side.

Only rows with a language whose crc32(doc_id as text) leaves another remainder than ``held`` modulo
``folds`` are learned from. A null text or one without a letter is ``und`` with score 0, as is every
text if no language was learned. Equal proportions go to the smaller name. Ids may repeat or be null
(a null id is never held out); an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendtable.functions.columns import ref, unused_name

from .common import fold_of, forget, hand_back, prepared, task, text_groups
from .ngrams import distinct_words, ngrams

LENGTHS = (1, 2, 3, 4)
BUCKETS = 1 << 16
UNKNOWN = "und"
ROUNDS = 12

RESULTS = ("held_out", "lang_pred", "score")
#: A document is rejected if no language has this share of its words.
LEAST_SHARE = 0.5

_COUNTS = "lang string, bucket int, n bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's n-grams by language, for rows (lang, text)."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for langs, raw, ends in text_groups(batch):
            names, code = np.unique(np.array(langs.to_pylist(), object).astype(str), return_inverse=True)
            folded, starts, sizes, text, word, times = distinct_words(raw, ends)
            found, owner = ngrams(folded, starts, sizes, LENGTHS, BUCKETS)
            for i, name in enumerate(names.tolist()):
                mine = code[text] == i
                of_word = np.bincount(word[mine], times[mine], minlength=len(starts))
                counts = np.bincount(found, of_word[owner], minlength=BUCKETS).astype(np.int64)
                held[name] = held.get(name, 0) + counts
    for name, counts in held.items():
        at = np.flatnonzero(counts)
        columns = [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def learn(training: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of rows (lang, text), and for each the logarithms of the buckets' shares."""
    counted = training.mapInArrow(task(_count), _COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # one row for each language, as long as the table of buckets
    rows = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).toArrow()
    order = np.argsort(np.array(rows.column("lang").to_pylist(), object)) if len(rows) else []
    langs = [rows.column("lang")[int(i)].as_py() for i in order]
    shares = np.zeros((len(langs), BUCKETS))
    for j, i in enumerate(order):
        cells = rows.column("cells")[int(i)].values
        counts = np.full(BUCKETS, 0.5)
        counts[cells.field("bucket").to_numpy()] += cells.field("n").to_numpy()
        shares[j] = np.log(counts / counts.sum())
    return langs, shares


def _estimate(likely: np.ndarray, times: np.ndarray, begins: np.ndarray, doc: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for many documents, one row for each language: proportions, and the
    log-likelihood they reach (less that of each word's best language)."""
    total = np.add.reduceat(times, begins)
    for _ in range(rounds):
        joint = np.take(share, doc, 1) * likely
        joint *= times / joint.sum(0)
        share = np.add.reduceat(joint, begins, axis=1) / total
    reached = np.log((np.take(share, doc, 1) * likely).sum(0))
    return share, np.add.reduceat(times * reached, begins)


def mixtures(logs: np.ndarray, doc: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Proportions, a row for each language, in documents 0, 1, ... whose words, in order of documents,
    have log-likelihoods ``logs``, a row for each language too."""
    begins = np.flatnonzero(np.diff(doc, prepend=-1))
    n, size = len(begins), len(logs)
    # no word is impossible, so that a document may lose any language
    likely = np.ascontiguousarray(np.exp(np.maximum(logs - logs.max(0), -200)))
    words = np.add.reduceat(times, begins).astype(float)
    share, reached = _estimate(likely, times, begins, doc, np.full((size, n), 1 / size), ROUNDS)
    active = np.ones((size, n), bool)
    tried_docs = np.arange(n)
    for _ in range(size - 1):
        # of equal ones the later name goes
        smallest = size - 1 - np.where(active[:, tried_docs], share[:, tried_docs], 2.0)[::-1].argmin(0)
        mask = active[:, tried_docs]
        mask[smallest, np.arange(len(tried_docs))] = False
        tried = np.where(mask, np.maximum(share[:, tried_docs], 1e-6), 0)
        tried /= tried.sum(0)
        rows = np.flatnonzero(np.isin(doc, tried_docs)) if len(tried_docs) < n else np.arange(len(doc))
        local = np.searchsorted(tried_docs, doc[rows])
        first = np.flatnonzero(np.diff(local, prepend=-1))
        tried, gained = _estimate(np.take(likely, rows, 1), times[rows], first, local, tried, ROUNDS // 2)
        better = gained + 0.5 * np.log(words[tried_docs] + 1) >= reached[tried_docs]
        done = tried_docs[better]
        share[:, done], reached[done] = tried[:, better], gained[better]
        active[smallest[better], done] = False
        tried_docs = done
        if not len(tried_docs):
            break
    return share


def predict(raw: np.ndarray, ends: np.ndarray, langs: list[str], shares: np.ndarray) -> tuple[list[str | None], np.ndarray]:
    """Language and its proportion for each text; None without words."""
    n = len(ends) - 1
    folded, starts, sizes, text, word, times = distinct_words(raw, ends)
    best, score = np.full(n, -1), np.zeros(n)
    if len(text) and langs:
        found, owner = ngrams(folded, starts, sizes, LENGTHS, BUCKETS)
        logs = np.stack([np.bincount(owner, of_lang[found], minlength=len(starts)) for of_lang in shares])
        logs /= len(LENGTHS)
        some, doc = np.unique(text, return_inverse=True)
        share = mixtures(np.take(logs, word, 1), doc, times)
        best[some] = share.argmax(0)
        score[some] = np.minimum(share.max(0), 1.0)
    return [langs[b] if b >= 0 else None for b in best.tolist()], score


def with_language(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", lang: str = "lang", held: int = 1, folds: int = 3,
) -> DataFrame:
    """The documents with all their columns, and held_out, lang_pred and score, which take the place of
    columns of these names."""
    prepared(docs.sparkSession)
    fold = fold_of(id_column, folds)
    training = docs.filter(ref(lang).isNotNull() & ref(text).isNotNull() & (fold != held))
    langs, shares = learn(training.select(ref(lang).cast("string").alias("lang"), ref(text).alias("text")))
    model = docs.sparkSession.sparkContext.broadcast((langs, shares))
    names = [c for c in docs.columns if c not in RESULTS]
    told = unused_name(docs, "told")

    @F.arrow_udf("struct<lang:string,score:double>")
    def tell(texts: pa.Array) -> pa.Array:
        forget()
        langs, shares = model.value
        kinds, found = [], [np.zeros(0)]
        batch = pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], names=["none", "text"])
        for _, raw, ends in text_groups(batch):
            some, score = predict(raw, ends, langs, shares)
            kinds += some
            found.append(score)
        hand_back()
        return pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(np.concatenate(found))], ["lang", "score"])

    letters = F.coalesce(ref(text).rlike("\\p{L}"), F.lit(False))
    told_docs = docs.withColumn(told, tell(F.coalesce(ref(text), F.lit(""))))
    known = letters & F.col(f"{told}.lang").isNotNull()
    return told_docs.select(
        *[ref(c) for c in names],
        (fold == held).alias("held_out"),
        F.when(known, F.col(f"{told}.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col(f"{told}.score")).otherwise(0.0).alias("score"),
    )


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    found = with_language(docs.select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def in_languages(
    docs: DataFrame, wanted: Sequence[str] | None = None, least: float = LEAST_SHARE, text: str = "text",
    id_column: str = "doc_id", lang: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """The documents mostly in one of the wanted languages (by default any that was learned), with their own columns,
    and what the others were taken for: lang_pred, score band (tenths) and rejected, their number.

    A document is rejected if it is ``und`` (no letter), if its language is not wanted, or if the language
    has less than ``least`` of its words. If no language was learned nothing can be told: then only texts
    without a letter are rejected, whatever is wanted. Rows that repeat are judged alike; null ids and
    languages are kept as they are.
    """
    row = unused_name(docs, "row_")
    named = docs.select(ref(id_column).alias("doc_id"), ref(text).alias("text"), ref(lang).alias("lang"), F.struct("*").alias(row))
    told = with_language(named)
    nothing_learned = named.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", 3) != 1)).isEmpty()
    if nothing_learned:
        fits = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    else:
        fits = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
        if wanted is not None:
            fits = fits & F.col("lang_pred").isin(list(wanted))
    rejected = told.filter(~fits).groupBy("lang_pred", F.floor(F.col("score") * 10).alias("tenths")).agg(F.count("*").alias("rejected"))
    return told.filter(fits).select(f"{row}.*"), rejected


def drop_unknown(docs: DataFrame, wanted: Sequence[str] | None = None, least: float = LEAST_SHARE) -> DataFrame:
    """The documents that ``in_languages`` keeps."""
    return in_languages(docs, wanted, least)[0]
