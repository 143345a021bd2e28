"""Language by Bayesian fusion of text, markup, address and host evidence.

log P(lang | all) = tempered log likelihood of the text's letter trigrams
                  + log P(declared language | lang)
                  + log P(address suffix | lang)
                  + log prior(lang | host).

The trigram model is fitted on labelled rows, at most about ``SAMPLE_ROWS``
of them, taken by a hash of the key.  A first pass over all rows takes each
row's language by its text alone; grouped counts of it give the reliability of
declarations and suffixes and the host priors, smoothed along
host -> domain -> all rows:
``p(l | host) = (n(host, l) + K p(l | domain)) / (n(host) + K)``, and the same
for domains.  The second pass fuses everything.  A row is accepted if its text
has a letter trigram and its best language reaches ``least``.  The posterior is
over the fitted languages only: a text in any other language, or of random
letters, gets the nearest known one, nearly always above ``least``.  In effect
only texts without letters are rejected; there is no hypothesis "other".

Edge cases: a null or empty text, or one without letters, is not accepted (its
language is the best by the other evidence); a null or unknown declaration,
suffix or host is a value of its own; null and repeated keys are kept row by
row; columns of the input stay (one named like an output is replaced); an
empty table gives no rows; with no labelled row nothing is accepted and the
language is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.llm._common import mix64, save_table, text_slices

SAMPLE_ROWS = 10_000
MAX_LANGUAGES = 64
BUCKETS = 1 << 14
TEMPER = 1 / 3          # trigrams overlap: three of them count as one
FLATTEN = 0.1           # add this count to every bucket
K = 20.0                # weight of the level above in the host priors
LEAST = 0.5
BROADCAST_HOSTS = 200_000

_MAP = np.full(256, 32, np.uint8)
_MAP[65:91] = np.arange(97, 123)
_MAP[97:123] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)
_HASH = mix64(np.arange(3 * 256, dtype=np.uint64) + np.uint64(71)).reshape(3, 256)


@dataclass
class TextModel:
    languages: list[str]
    table: np.ndarray       # languages x buckets, log probabilities


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every letter trigram, offsets by text).  Other characters
    count as spaces; trigrams with a space in the middle are left out."""
    buf = _MAP[np.frombuffer(b"".join(b" " + t + b"  " for t in texts), np.uint8)]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 3 for t in texts], out=at[1:])
    place = np.flatnonzero(buf[1:-1] != 32)
    h = _HASH[0][buf[place]] ^ _HASH[1][buf[place + 1]] ^ _HASH[2][buf[place + 2]]
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64), np.searchsorted(place, at)


def likelihoods(model: TextModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(tempered log likelihoods texts x languages, trigrams of each text)."""
    bucket, at = trigrams(texts)
    n = np.diff(at)
    out = np.zeros((len(texts), len(model.languages)))
    some = np.flatnonzero(n)
    if len(some):
        for i, row in enumerate(model.table):
            out[some, i] = np.add.reduceat(row[bucket], at[:-1][some])
    return out * TEMPER, n


def fit_text(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> TextModel:
    """Trigram frequencies by label from a bounded sample of labelled rows."""
    rows = labelled.select(F.xxhash64(labelled[key]).alias("h"), labelled[text].cast("string").alias("text"),
                           F.lower(labelled[label].cast("string")).alias("label"))
    rows = rows.where(F.col("text").isNotNull() & F.col("label").rlike("^[a-z]{2,3}$"))
    share = max(1, -(-rows.count() // SAMPLE_ROWS))
    rows = rows.where(F.pmod("h", F.lit(share)) == 0)
    labels = [r.label for r in rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_LANGUAGES).collect()]
    labels.sort()

    def run(batches):
        total = np.zeros((len(labels), BUCKETS), np.int64)
        for b in text_slices(batches):
            bucket, at = trigrams([t.encode() for t in b.column("text").to_pylist()])
            for i, label in enumerate(b.column("label").to_pylist()):
                if label in labels:
                    total[labels.index(label)] += np.bincount(bucket[at[i]:at[i + 1]], minlength=BUCKETS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(total[lang, bucket])],
                                         names=["lang", "bucket", "n"])

    table = np.full((len(labels), BUCKETS), FLATTEN)
    counts = rows.mapInArrow(run, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for r in counts.collect():      # at most MAX_LANGUAGES x BUCKETS rows
        table[r.lang, r.bucket] += r.n
    return TextModel(labels, np.log(table / table.sum(axis=1, keepdims=True)))


def _known(c: Column | None, languages: list[str]) -> Column:
    """A language code, "" for none, "?" for any other value."""
    if c is None:
        return F.lit("")
    code = F.regexp_extract(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "^[ ._-]*([a-z]{2,3})", 1)
    return F.when(code.isin(languages or ["-"]), code).when(code == "", "").otherwise("?")


def _first_pass(model: TextModel):
    def run(batches):
        for b in text_slices(batches):
            ll, n = likelihoods(model, [t.encode() for t in b.column("text").to_pylist()])
            best = np.where(n > 0, ll.argmax(axis=1), -1)
            yield pa.RecordBatch.from_arrays([b.column("declared"), b.column("suffix"), b.column("host"),
                                              b.column("domain"), pa.array(best.astype(np.int64))],
                                             names=["declared", "suffix", "host", "domain", "best"])
    return run


def _reliability(counts: DataFrame, column: str, languages: list[str]) -> dict[str, list[float]]:
    """log P(value | language) for each value of a declared code or suffix."""
    rows = counts.where("best >= 0").groupBy(column, "best").agg(F.sum("n").alias("n")).collect()
    n = {(r[column], r.best): r.n for r in rows}
    values = ["", "?", *languages]
    size = [sum(n.get((v, i), 0) for v in values) for i in range(len(languages))]
    return {v: [float(np.log((n.get((v, i), 0) + 1) / (size[i] + len(values)))) for i in range(len(languages))]
            for v in values}


def _by_language(counts: DataFrame, by: str, size: int) -> DataFrame:
    """Rows of each group by language: ``by, of (a domain), n0, n1, ..``."""
    per = [F.sum(F.when(F.col("best") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(size)]
    return counts.where("best >= 0").groupBy(by).agg(F.max("domain").alias("of"), *per)


def _smoothed(above: list[Column], size: int) -> Column:
    """Language shares of a group, smoothed by those of the level above."""
    total = sum((F.col(f"n{i}") for i in range(size)), F.lit(0))
    return F.array(*[(F.col(f"n{i}") + K * above[i]) / (total + K) for i in range(size)])


def _second_pass(model: TextModel, tables: list[dict], names: list[str], text: str, least: float):
    size = len(model.languages)

    def run(batches):
        for b in text_slices(batches, text):
            raw = [(t or "").encode() for t in b.column(text).to_pylist()]
            ll, n = likelihoods(model, raw)
            for column, table in zip(("__declared", "__suffix"), tables):
                ll += np.array([table[v] for v in b.column(column).to_pylist()]).reshape(-1, size)
            ll += np.log(np.array(b.column("__prior").to_pylist(), float).reshape(-1, size))
            p = np.exp(ll - ll.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            top = p[np.arange(len(best)), best]
            new = {"language": pa.array([model.languages[i] for i in best], pa.string()), "language_p": pa.array(top),
                   "accepted": pa.array((n > 0) & (top >= least))}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else b.column(c) for c in names], names=names)
    return run


def classify(df: DataFrame, model: TextModel, text: str = "text", declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None, domain: Column | None = None,
             least: float = LEAST) -> DataFrame:
    """``df`` with ``language, language_p, accepted``.  ``declared``,
    ``suffix``, ``host`` and ``domain``: columns of ``df``, where there are any."""
    added = ("language", "language_p", "accepted")
    schema = T.StructType([f for f in df.schema.fields if f.name not in added])
    names = list(schema.names)
    schema = schema.add("language", "string").add("language_p", "double").add("accepted", "boolean")
    size = len(model.languages)
    if not size:
        return df.select(*[df[f"`{n}`"] for n in names], F.lit(None).cast("string").alias("language"),
                         F.lit(0.0).alias("language_p"), F.lit(False).alias("accepted"))
    blank = F.lit("")
    host = blank if host is None else F.lower(F.coalesce(host.cast("string"), blank))
    domain = blank if domain is None else F.lower(F.coalesce(domain.cast("string"), blank))
    rows = df.select(*[df[f"`{n}`"] for n in names], _known(declared, model.languages).alias("__declared"),
                     _known(suffix, model.languages).alias("__suffix"), host.alias("__host"), domain.alias("__domain"))
    counts = save_table(
        rows.select(F.coalesce(F.col(text).cast("string"), blank).alias("text"), *[
            F.col(f"__{c}").alias(c) for c in ("declared", "suffix", "host", "domain")])
        .mapInArrow(_first_pass(model), "declared string, suffix string, host string, domain string, best long")
        .groupBy("declared", "suffix", "host", "domain", "best").agg(F.count("*").alias("n")), "language-counts")
    tables = [_reliability(counts, c, model.languages) for c in ("declared", "suffix")]

    whole = {r.best: r.n for r in counts.where("best >= 0").groupBy("best").agg(F.sum("n").alias("n")).collect()}
    total = sum(whole.values())
    overall = [(whole.get(i, 0) + 1) / (total + size) for i in range(size)]
    domains = _by_language(counts, "domain", size).select(
        F.col("domain").alias("d"), _smoothed([F.lit(x) for x in overall], size).alias("above"))
    hosts = _by_language(counts, "host", size)
    above = [F.coalesce(F.col("above")[i], F.lit(overall[i])) for i in range(size)]
    hosts = save_table(hosts.join(domains, hosts["of"] == domains["d"], "left")
                       .select(F.col("host").alias("__h"), _smoothed(above, size).alias("__prior")), "language-hosts")
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    joined = (rows.join(hosts, rows["__host"] == hosts["__h"], "left")
              .withColumn("__prior", F.coalesce("__prior", F.array(*map(F.lit, overall))))
              .select(*names, "__declared", "__suffix", "__prior"))
    return joined.mapInArrow(_second_pass(model, tables, schema.names, text, least), schema)


# ------------------------------------------------------------- web pages

def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> dict[str, Column]:
    """Columns for pages: visible text, the markup's language, the address
    suffix (a language part of the path, else the host's last label), host and
    domain (its last two labels)."""
    source = F.coalesce(pages[html].cast("string"), F.lit(""))
    visible = F.regexp_replace(source, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[a-z/!?][^>]*>", " ")
    address = F.coalesce(pages[url].cast("string"), F.lit(""))
    host = F.regexp_extract(address, "(?s)^.*?://([^/?#]*)", 1)
    part = F.regexp_extract(F.lower(address), "(?s)^.*?://[^/?#]*/([a-z]{2})(?:/|[?#]|$)", 1)
    last = F.regexp_extract(F.lower(host), r"\.([a-z]{2})(?::[0-9]*)?$", 1)
    return {"text": visible, "declared": F.regexp_extract(source, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1),
            "suffix": F.when(part != "", part).otherwise(last), "host": host,
            "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)}
