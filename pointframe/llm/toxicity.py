"""Toxicity by class-conditional Kneser-Ney models of characters.

Two interpolated Kneser-Ney models of order 5, over characters within words, are
counted from the labelled rows: one of toxic texts, one of ordinary texts. Their
orders 5 to 3 are the class's own; orders 2 and 1 are counted over both classes
together, so an expression rare in a class falls back on shared counts and says
little either way. A word's evidence is the difference of its two
log-likelihoods. A document's features are normalised by its length: the mean
difference per word, and the rate and logarithm of the number of words above each
level of ``strong``; a
logistic curve fitted on labelled rows that the counts have not seen turns them
into a score between 0 and 1.

Counting and scoring cover all rows and whole texts. The counts are exact and stay
Spark tables that grow with the corpus; the distinct n-grams of the texts are joined
to them. The evidence of these n-grams is broadcast only when a count proves them
few (``slots``); beyond, the words of the texts are joined with it. The curve is
fitted on at most ``max_fit_rows`` rows, the first by a hash of the id.

Defined results: null and blank texts score as a text without evidence (the
curve at zero). Repeated rows are scored one by one; a label repeated for an id
counts as toxic if any is. Without labelled rows of both classes every score is
0. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, pick, plain, sized
from pointframe.session import ship_package

ORDER, OWN, FLOOR = 5, 3, 1 / 256
# discounts of n-grams counted once, twice and more often, and the mass a context hands down per kind
DISCOUNTS, HANDED = (1.0, 1.4, 1.8), 1.2
BITS = 10
MASKS = np.array([(1 << (BITS * k)) - 1 for k in range(ORDER + 1)], dtype=np.int64)
CHUNK = 1 << 18
FEATURES = 5


def clean(text: Column) -> Column:
    """Lower-cased words (runs of letters and marks; digits count as 0) with single blanks between."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.trim(t)


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of (row numbers, texts) of about CHUNK characters; longer texts are cut between words."""
    rows, out, size = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > CHUNK:
                end = max(t.rfind(" ", at, at + CHUNK), 0) or at + CHUNK
                end = end if end > at else at + CHUNK
            rows.append(i)
            out.append(t[at:end].strip())
            size += end - at
            at = end
            if size >= CHUNK:
                yield rows, out
                rows, out, size = [], [], 0
    if rows:
        yield rows, out


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each symbol of each word (its end included): the packed n-gram, the word's number, and
    for each word the number of its text."""
    joined = " " + " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = np.where(points < 1000, points, 1000 + points % 23).astype(np.int64)
    code[points == 32] = 1
    code[(points >= 48) & (points <= 57)] = 48
    at = np.arange(len(code))
    space = code == 1
    before = np.concatenate([[0], np.maximum.accumulate(np.where(space, at, 0))[:-1]])
    reach = at - before
    real = (at > 0) & ~(space & (reach == 1))
    key = code.copy()
    for k in range(1, ORDER):
        key[k:] |= code[:-k] << (BITS * k)
    key &= MASKS[np.minimum(ORDER, reach + 1)]
    ends = space & real
    word = np.cumsum(ends) - ends  # a word's end belongs to it
    limits = np.cumsum([len(t) + 1 for t in texts])  # position of the blank that ends each text
    return key[real], word[real], np.searchsorted(limits, at[ends])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, key, n), combined over the whole task."""
    held: dict[int, list[np.ndarray]] = {}

    def merge(parts: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(parts, axis=1)
        keys, at = np.unique(both[0], return_inverse=True)
        return np.stack([keys, np.bincount(at, both[1]).astype(np.int64)])

    def rows(label: int, table: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"label": pa.array(np.full(table.shape[1], label, dtype=np.int32)),
                                           "key": pa.array(table[0]), "n": pa.array(table[1])})

    for batch in batches:
        labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
        for label in sorted(set(labels)):
            for _, run in _pieces([t for t, x in zip(texts, labels, strict=True) if x == label]):
                keys, n = np.unique(ngrams(run)[0], return_counts=True)
                parts = held.setdefault(label, [])
                parts.append(np.stack([keys, n]))
                if sum(p.shape[1] for p in parts) > 3_000_000:
                    held[label] = [merge(parts)]
                    if held[label][0].shape[1] > 1_500_000:  # bounded memory: hand on what there is
                        yield rows(label, held.pop(label)[0])
    for label, parts in held.items():
        if parts:
            yield rows(label, merge(parts))


def count_model(train: DataFrame) -> dict[int, DataFrame]:
    """The exact counts of the two models from rows (label 0 or 1, cleaned text), a table per order:
    label (-1 for both classes together), key, w."""
    ship_package(train.sparkSession)
    counts = train.mapInArrow(_count, "label int, key long, n long")
    level = materialize(counts.groupBy("label", "key").agg(F.sum("n").alias("w")), "ngrams")
    levels = {ORDER: level}
    for k in range(ORDER - 1, 0, -1):
        if k == OWN - 1:  # from here on both classes count together
            level = level.groupBy(F.lit(-1).alias("label"), "key").agg(F.sum("w").alias("w"))
        # Kneser-Ney: the number of different n-grams that end so; those cut at a word's start count in full
        started = F.shiftright("key", BITS * k) == 0
        level = level.groupBy("label", F.col("key").bitwiseAND(F.lit(int(MASKS[k]))).alias("key")).agg(
            F.sum(F.when(started, F.col("w")).otherwise(1)).alias("w"))
        levels[k] = level = materialize(level, f"ngrams{k}")
    return levels


def evidence(grams: DataFrame, levels: dict[int, DataFrame], max_broadcast: int) -> DataFrame:
    """``grams`` (key) with e, log P(symbol | toxic) - log P(symbol | ordinary) of the packed n-gram."""
    p = {c: F.lit(FLOOR) for c in (0, 1)}
    out = grams
    for k in range(1, ORDER + 1):
        classes = {c: c if k >= OWN else -1 for c in (0, 1)}

        def sides(value: Column, name: str, classes=classes) -> list[Column]:
            return [F.max(F.when(F.col("label") == classes[c], value)).alias(f"{name}{c}") for c in (0, 1)]

        seen = levels[k].groupBy(F.col("key").alias("g")).agg(*sides(F.col("w"), "seen"))
        contexts = levels[k].groupBy("label", F.shiftright("key", BITS).alias("x")).agg(F.sum("w").alias("w"), F.count("*").alias("k"))
        contexts = contexts.groupBy("x").agg(*sides(F.col("w"), "total"), *sides(F.col("k"), "kinds"))
        gram = F.col("key").bitwiseAND(F.lit(int(MASKS[k])))
        out = out.withColumn("gram", gram).withColumn("context", F.shiftright(gram, BITS))
        out = out.join(sized(materialize(seen, "seen"), max_broadcast), F.col("gram") == F.col("g"), "left")
        out = out.join(sized(materialize(contexts, "contexts"), max_broadcast), F.col("context") == F.col("x"), "left")
        for c in (0, 1):
            n, total, kinds = (F.coalesce(f"{t}{c}", F.lit(0)).cast("double") for t in ("seen", "total", "kinds"))
            off = F.least(n, F.when(n <= 1, DISCOUNTS[0]).when(n <= 2, DISCOUNTS[1]).otherwise(DISCOUNTS[2]))
            back = F.least(total, HANDED * kinds)
            p[c] = F.when(total > 0, (n - off + back * p[c]) / F.greatest(total, F.lit(1.0))).otherwise(p[c])
        out = out.withColumns({f"p{c}": p[c] for c in (0, 1)}).select("key", "p0", "p1")
        p = {c: F.col(f"p{c}") for c in (0, 1)}
    return out.select("key", (F.log(p[1] + 1e-12) - F.log(p[0] + 1e-12)).alias("e"))


def features(texts: list[str], known: np.ndarray, value: np.ndarray, strong: tuple[float, float]) -> np.ndarray:
    """Of cleaned texts, by the evidence of all their n-grams (``known``, sorted, and ``value``)."""
    sums = np.zeros((len(texts), 4))  # words, evidence, words above each level
    for rows, run in _pieces(texts):
        keys, word, text = ngrams(run)
        if not len(text):
            continue
        by_word = np.bincount(word, value[np.searchsorted(known, keys)], minlength=len(text))
        row = np.asarray(rows)[text]
        for j, x in enumerate((np.ones(len(row)), np.clip(by_word, -4, 8), by_word > strong[0], by_word > strong[1])):
            sums[:, j] += np.bincount(row, x, minlength=len(texts))
    n = np.maximum(sums[:, 0], 1)
    rate = np.minimum(50 * sums[:, 2:] / n[:, None], 5)
    return np.hstack([(sums[:, 1] / n)[:, None], rate, np.log1p(sums[:, 2:])])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the constant."""
    a = np.hstack([x, np.ones((len(x), 1))])
    b, ridge = np.zeros(a.shape[1]), penalty * np.eye(a.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve(a.T @ (a * np.maximum(p * (1 - p), 1e-6)[:, None]) + ridge, a.T @ (y - p) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def _featured(rows: DataFrame, shared, strong: tuple[float, float], keep: list[str]) -> DataFrame:
    """``rows`` (text and ``keep``) with features x0, x1, ... for text; one Arrow pass. ``shared``: n-grams and evidence."""
    schema = rows.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = shared.value
        for b in batches:
            x = features(b.column("text").to_pylist(), known, value, strong)
            cols = {k: b.column(k) for k in keep} | {f"x{j}": pa.array(x[:, j]) for j in range(FEATURES)}
            yield pa.RecordBatch.from_pydict(cols)

    for j in range(FEATURES):
        schema = schema.add(f"x{j}", "double")
    return rows.select(*keep, "text").mapInArrow(run, schema)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to (key, word, gram): every n-gram of every word, words numbered within the task."""
    done = 0
    for b in batches:
        for rows, run in _pieces(b.column("text").to_pylist()):
            grams, word, text = ngrams(run)
            if len(text):
                which = np.asarray(rows)[text][word]
                yield pa.RecordBatch.from_pydict({"key": b.column("key").take(pa.array(which)), "word": pa.array(word + done), "gram": pa.array(grams)})
                done += len(text)


def _joined(rows: DataFrame, table: DataFrame, strong: tuple[float, float], keep: list[str]) -> DataFrame:
    """What ``_featured`` gives, by joins with the evidence ``table`` (key, e) instead of a broadcast."""
    texts = rows.select("key", "text").dropDuplicates(["key"])
    found = texts.mapInArrow(_occurrences, "key long, word long, gram long").join(table.withColumnRenamed("key", "gram"), "gram")
    by_word = found.groupBy("key", "word").agg(F.sum("e").alias("e"))
    above = [F.sum((F.col("e") > x).cast("double")) for x in strong]
    sums = by_word.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.greatest(F.lit(-4.0), F.least(F.lit(8.0), F.col("e")))).alias("s"),
                                      *[x.alias(f"a{j}") for j, x in enumerate(above)])
    x = [F.col("s") / F.col("n"), *[F.least(F.lit(5.0), 50 * F.col(f"a{j}") / F.col("n")) for j in (0, 1)], *[F.log1p(f"a{j}") for j in (0, 1)]]
    sums = sums.select(F.col("key").alias("k_"), *[c.alias(f"x{j}") for j, c in enumerate(x)])
    out = rows.select("key", *[c for c in keep if c != "key"]).join(sums, F.col("key") == F.col("k_"), "left")
    return out.select(*keep, *[F.coalesce(f"x{j}", F.lit(0.0)).alias(f"x{j}") for j in range(FEATURES)])


def score_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", *,
                   label_id: str = "doc_id", label: str = "toxic", learn: Column | None = None, slots: int = 1 << 20,
                   strong: tuple[float, float] = (2.0, 4.0), max_fit_rows: int = 20_000, max_broadcast: int = 8_000_000) -> DataFrame:
    """Per row of ``docs``: id, key (a hash of its text), score. ``learn``: condition over id; only rows that meet it give labels.

    ``slots``: the most n-grams whose evidence is broadcast; with more, the texts' n-grams are joined with it.
    """
    ship_package(docs.sparkSession)
    rows = pick(docs, id=id, text=text).select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), clean(F.col("text")).alias("text"))
    known = pick(labels, id=label_id, label=label).where("label is not null and id is not null")
    if learn is not None:
        known = known.where(learn)
    known = materialize(known.groupBy("id").agg(F.max("label").cast("int").alias("label")).where("label in (0, 1)")
                        .withColumn("fold", F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(4))), "labels")
    train = rows.join(sized(known, max_broadcast), "id")
    levels = count_model(train.where("fold > 0").select("label", "text"))
    grams = rows.select(F.lit(0).alias("label"), "text").mapInArrow(_count, "label int, key long, n long").select("key").distinct()
    table = materialize(evidence(materialize(grams, "grams"), levels, slots), "evidence")
    fit = train.where("fold = 0").orderBy(F.xxhash64(F.lit("order"), "id")).limit(max_fit_rows)
    if table.limit(slots + 1).count() <= slots:
        held = table.orderBy("key").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast((held.column("key").to_numpy(), held.column("e").to_numpy()))

        def featured(some: DataFrame, keep: list[str]) -> DataFrame:
            return _featured(some, shared, strong, keep)
    else:

        def featured(some: DataFrame, keep: list[str]) -> DataFrame:
            return _joined(some, table, strong, keep)

    seen = featured(materialize(fit.select("key", "label", "text"), "fit"), ["label"]).toPandas()
    x, y = seen[[f"x{j}" for j in range(FEATURES)]].to_numpy(), seen["label"].to_numpy(dtype=float)
    if len(set(y)) < 2:
        return rows.select("id", "key", F.lit(0.0).alias("score"))
    b = _logistic(x, y)
    z = sum((F.col(f"x{j}") * float(b[j]) for j in range(FEATURES)), F.lit(float(b[-1])))
    return featured(rows, ["id", "key"]).select("id", "key", (1 / (1 + F.exp(-z))).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", *, threshold: float = 0.7,
               **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    scored = score_toxicity(docs, labels, id, text, **options)
    bad = materialize(scored.where(F.col("score") >= threshold).select(F.col("id").alias("bad_"), "key").distinct(), "toxic")
    tmp, names = plain(docs)
    hashed = tmp.withColumn("h_", F.xxhash64(F.coalesce(f"c{names.index(text)}", F.lit(""))))
    same = hashed[f"c{names.index(id)}"].eqNullSafe(F.col("bad_")) & (F.col("h_") == F.col("key"))
    return hashed.join(sized(bad, 4_000_000), same, "left_anti").drop("h_").toDF(*names)
