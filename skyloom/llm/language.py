"""Language mixtures of documents by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

BUCKETS = 1 << 16
UNKNOWN = "und"
#: A letter is a code point of Unicode category L (number signs such as ½, ² or Ⅷ are not).
LETTER = regex.compile(r"\p{L}")
#: Bytes to bytes: ASCII letters and bytes of other scripts stay, the rest separates words.
LETTERS = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
#: Bytes of text that are turned into numbers at once.
CHUNK = 2_000_000
MAX_LANGUAGES = 512


def _data(text: str) -> np.ndarray:
    return np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(LETTERS) + b" ", np.uint8)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the byte trigram around each letter byte, and where words start among them."""
    data = _data(text).astype(np.uint32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    letter = data[1:-1] != 32
    starts = letter & (data[:-2] == 32)
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16))[letter]
    return bucket, np.flatnonzero(starts[letter])


def byte_counts(text: str) -> np.ndarray:
    """How often each byte occurs in the trigrams of a text."""
    data = _data(text)
    letter = data[1:-1] != 32
    return sum(np.bincount(part[letter], minlength=256) for part in (data[:-2], data[1:-1], data[2:]))


def train(labelled: DataFrame, smoothing: float = 0.5) -> "Model":
    """Trigram log-likelihoods of each language from all rows of (text, lang); null values are left out.

    Bytes are counted along with trigrams, for the background model of letters in no order.
    Counts are added up within a task, then by Spark. The model has ``BUCKETS`` numbers a language; more than
    ``MAX_LANGUAGES`` languages are refused, so what is sent to tasks stays bounded.
    """

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                own = counts.setdefault(lang.as_py(), np.zeros(BUCKETS + 256, np.int64))
                bucket, _ = grams(text.as_py())
                own[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                own[BUCKETS:] += byte_counts(text.as_py())
        for lang, own in counts.items():
            seen = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen)), pa.array(seen, pa.int32()), pa.array(own[seen])], ["lang", "bucket", "n"])

    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    counted = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = [r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()
    table = counted.toArrow().to_pydict()
    counts = np.full((len(languages), BUCKETS + 256), smoothing)
    place = {lang: i for i, lang in enumerate(languages)}
    np.add.at(counts, (np.array([place[x] for x in table["lang"]], np.int64), np.array(table["bucket"], np.int64)), np.array(table["n"], float))
    counts, bytes_ = counts[:, :BUCKETS], counts[:, BUCKETS:].sum(axis=0)
    scores = np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts
    # Half of it is even over the bytes seen, so that rare letters alone do not speak for a language.
    seen = bytes_ > bytes_.min()
    background = np.log(bytes_ / bytes_.sum() / 2 + np.where(seen, 0.5 / max(seen.sum(), 1), 0)) if languages else bytes_
    return Model(languages, np.ascontiguousarray(scores.T, np.float32), background)


class Model:
    """Log-likelihood of each trigram bucket under each language, and of each byte in a background without order."""

    def __init__(self, languages: list[str], scores: np.ndarray, background: np.ndarray):
        self.languages, self.scores, self.background = languages, scores, background

    def evidence(self, words: np.ndarray, shares: np.ndarray, counts: np.ndarray) -> float:
        """Log-likelihood of a text's words under a mixture less that of its bytes (``byte_counts``) in no order, for each trigram."""
        used = np.flatnonzero(shares > 0)
        if len(used):
            fit = np.logaddexp.reduce(words[:, used] + np.log(shares[used]), axis=1).sum(dtype=np.float64)
        else:
            fit = words.sum(axis=0, dtype=np.float64).max()
        return float((fit - counts @ self.background) / (counts.sum() / 3))

    def words(self, text: str) -> np.ndarray:
        """Log-likelihood of each word of a text (rows) under each language."""
        parts, step = [], max(1000, CHUNK // max(len(self.languages), 1))
        bucket, starts = grams(text)
        ends = np.append(starts, len(bucket))
        first = 0
        while first < len(starts):  # long texts a stretch of words at a time
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + step, "right")) - 1)
            here = self.scores[bucket[ends[first] : ends[last]]]
            parts.append(np.add.reduceat(here, starts[first:last] - ends[first], axis=0))
            first = last
        return np.concatenate(parts) if parts else np.empty((0, len(self.languages)), np.float32)

    def mixtures(self, texts: list[np.ndarray], rounds: int, penalty: float) -> list[tuple[np.ndarray, float]]:
        """For the words of each text: language proportions, and the certainty of the foremost language.

        Proportions are first estimated over all languages. The languages are then taken in the order of their
        proportions, one to all, the proportions estimated again for each such set; the set with the highest
        log-likelihood less ``penalty/2 * log(words)`` for each further language is selected. All texts
        are worked on together, a segment of rows each.
        """
        likelihood = np.concatenate(texts)
        counts = np.array([len(t) for t in texts])
        starts, many = np.concatenate([[0], np.cumsum(counts)[:-1]]), len(self.languages)
        top = likelihood.max(axis=1, keepdims=True)
        relative = np.exp(likelihood - top)
        total = np.add.reduceat(likelihood, starts, axis=0, dtype=np.float64)

        def estimate(shares, rounds):
            for _ in range(rounds):
                joint = relative * np.repeat(shares, counts, axis=0)
                joint /= joint.sum(axis=1, keepdims=True)
                shares = (np.add.reduceat(joint, starts, axis=0) / counts[:, None]).astype(np.float32)
            fit = np.log((relative * np.repeat(shares, counts, axis=0)).sum(axis=1)) + top[:, 0]
            return shares, np.add.reduceat(fit, starts, dtype=np.float64)

        overall, _ = estimate(np.full((len(texts), many), 1 / many, np.float32), rounds)
        rank = np.argsort(np.argsort(-overall, axis=1, kind="stable"), axis=1)
        best, chosen = np.full(len(texts), -np.inf), overall
        for size in range(1, many + 1):
            tiny = np.float32(1e-6)  # no word is impossible under the selected set
            shares = np.where(rank < size, overall + tiny, 0)
            if size == 1:
                # One language: its likelihood is the plain sum; the likeliest one, not the commonest, counts.
                shares = (np.arange(many) == total.argmax(axis=1)[:, None]).astype(np.float32)
                fit = total.max(axis=1)
            else:
                shares, fit = estimate((shares / shares.sum(axis=1, keepdims=True)).astype(np.float32), max(2, rounds // 3))
            value = fit - penalty / 2 * (size - 1) * np.log(np.maximum(counts, 2))
            better = value > best
            best, chosen = np.where(better, value, best), np.where(better[:, None], shares, chosen)
        certain = np.exp(total - total.max(axis=1, keepdims=True))
        certain = (certain / certain.sum(axis=1, keepdims=True)).max(axis=1)
        return list(zip(chosen, certain))


def identify(docs: DataFrame, model: Model, rounds: int = 8, penalty: float = 4.0, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``columns``, lang_pred, score, languages (those selected, with their proportions), evidence.

    lang_pred is the language with the largest proportion, the first by name among equals. score is its proportion
    times the certainty that it, rather than another single language, made the text; 0 to 1. evidence says, however many languages
    are mixed, how much better they explain the words than the same letters in no order do, in nats a trigram; 0 or less
    means no learned language. A text that is null or has no
    letter is ``und`` with score and evidence 0 and no languages, as is every text when nothing was learned. Texts are read whole. Repeated rows and null ids
    stay as they are; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held = docs.select(*columns, "text" if "text" not in columns else F.lit(0).alias("unused"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema.fields[: len(columns)])

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            result: list = [(UNKNOWN, 0.0, {}, 0.0)] * len(texts)
            held, places, size = [], [], 0

            def settle():
                for place, words, (shares, certain) in zip(places, held, model.mixtures(held, rounds, penalty)):
                    lang = int(shares.argmax())
                    kept = {model.languages[i]: float(shares[i]) for i in np.argsort(-shares, kind="stable") if shares[i] > 1e-4}
                    result[place] = (model.languages[lang], min(1.0, float(shares[lang]) * float(certain)), kept, model.evidence(words, shares, byte_counts(texts[place])))

            for place, text in enumerate(texts):
                if text is None or not model.languages or not LETTER.search(text):
                    continue
                words = model.words(text)
                if len(words):
                    held.append(words)
                    places.append(place)
                    size += words.size
                if size > CHUNK:
                    settle()
                    held, places, size = [], [], 0
            if held:
                settle()
            lang, score, shares, evidence = zip(*result) if result else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array([list(s.items()) for s in shares], pa.map_(pa.string(), pa.float64())), pa.array(evidence, pa.float64())],
                [*columns, "lang_pred", "score", "languages", "evidence"],
            )

    return held.mapInArrow(run, f"{kinds}, lang_pred string, score double, languages map<string,double>, evidence double")
