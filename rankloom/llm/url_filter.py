"""URL rules, and logistic regression on character n-grams for the rest.

The regression learns from a small labelled table of URLs that are made of
words people have judged (``labelled_urls``), not from the rules or the pages.

Everything is DataFrame functions and Spark ML, row by row without a shuffle;
only the small labelled table is gathered for training.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of hosts that were judged by hand, and the places they are put into.  Frames, endings and most
# paths are the same for both labels, so that only the words tell them apart.
BLOCKED_WORDS = """casino poker jackpot roulette slots betting bets bookmaker lottery bingo pills viagra cialis pharmacy steroids
 slimming adult porn xxx sexcam escort hookup nude erotic fetish ads adserver tracker track popunder clickbait banner spam
 malware phishing keygen crack warez torrent pirated cheats payday loans forex bitcoin-doubler giveaway sweepstake
 replica counterfeit fake-watches free-money getrich cheap win-big farm-links linkfarm doorway scam"""
PLAIN_WORDS = """news blog garden school library museum recipes kitchen weather travel hotel railway airport university college
 science history music guitar theatre cinema books poetry letters painting gallery photo nature forest river mountain
 animals birds horses dogs cats health clinic doctor hospital family children parents teacher student football tennis
 cycling running swimming sailing city town village council police court law bank market shop bakery coffee tea wine
 farmers bread cheese fish fruit flowers house building furniture paper print engine car bicycle train computer software
 code data network phone radio energy solar water wind stone wood metal glass wool fashion shoes watches clock art
 craft club church choir festival holiday island harbour bridge street square park tower castle winter summer spring"""
# Names that mean nothing, as most hosts have: three of these one after the other.
SYLLABLES = "th er on ti an re in st ha ed en to al or le ba mo ri sa ku ne ly vo di ga"
NAMES = 220
FRAMES = "{w}.{t} www.{w}.{t} {f}-{w}.{t} {w}-{f}.example.{t} blog.{w}{f}.{t} m.{w}-{f}.example.{t}"
FILLERS = "my the our day city world home one best online top"
ENDINGS = "com net org info de fr es"
PATHS = "/ /en/{n} /fr/{n}.html /de/{n}/ /es/{n} /index.html /en/{n}/"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
SIZES = (2, 3, 4)


@dataclass(frozen=True)
class Rule:
    """``place`` is host and path together, as in ``example.com/en/``."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, "(?s)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, else NULL; rules are a short list written by people."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.place), r.place)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, rule.place).otherwise(found)
    return found


def _chars(text: Column) -> Column:
    return F.filter(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: c != "")


def _grams(chars: Column, mark: str, size: int) -> Column:
    """The n-grams of a stored array of characters; linear in its length."""

    def gram(char, at):
        return F.concat(F.lit(mark), char, *[F.get(chars, at + k) for k in range(1, size)])

    return F.transform(F.slice(chars, 1, F.greatest(F.size(chars) - size + 1, F.lit(0))), gram)


def features(df: DataFrame, buckets: int) -> DataFrame:
    """Adds ``features``: hashed character n-grams of ``host`` and ``path``, each position once, with length one."""
    split = df.withColumns({"_h": _chars(F.col("host")), "_p": _chars(F.col("path"))})
    grams = split.withColumn("_grams", F.concat(*[_grams(F.col(c), c[1], n) for c in ("_h", "_p") for n in SIZES]))
    counted = HashingTF(inputCol="_grams", outputCol="_counts", numFeatures=buckets).transform(grams)
    return Normalizer(inputCol="_counts", outputCol="features").transform(counted).drop("_grams", "_counts", "_h", "_p")


@dataclass
class UrlJudge:
    """Score of a URL: the probability that it is to be blocked."""

    model: object
    constant: float | None
    buckets: int

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` to rows with ``host`` and ``path``."""
        if self.model is None:
            return df.withColumn("score", F.lit(self.constant))
        from pyspark.ml.functions import vector_to_array

        scored = self.model.transform(features(df, self.buckets))
        return scored.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def train_judge(labelled: DataFrame, max_rows: int = 2000, buckets: int = 1 << 13, steps: int = 30) -> UrlJudge:
    """Fit on a small labelled table ``host, path, verdict``.

    At most ``max_rows`` different rows are used, those with the smallest md5 of
    host and path, so a larger table gives a sample of bounded size.  They are
    put into one partition: the sums, and so the model, do not depend on the
    partitioning.  Without any row everything is allowed; with one verdict only,
    everything gets that verdict.
    """
    few = (
        labelled.select("host", "path", (F.col("verdict") == BLOCK).cast("double").alias("label"))
        .distinct()
        .orderBy(F.md5(F.concat_ws("\n", "host", "path")), "host", "path", "label")
        .limit(max_rows)
        .coalesce(1)
        .persist()
    )
    kinds = [r["label"] for r in few.select("label").distinct().collect()]  # at most two rows
    if len(kinds) < 2:
        few.unpersist()
        return UrlJudge(None, kinds[0] if kinds else 0.0, buckets)
    model = LogisticRegression(maxIter=steps, regParam=1e-4).fit(features(few, buckets))
    few.unpersist()
    return UrlJudge(model, None, buckets)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], judge: UrlJudge, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score``, one row per input row.

    The verdict is that of the longest fitting rule, else block where the score
    is at least 0.5.  A NULL url and one without ``://`` have an empty host and
    path, fit no rule and are scored like any other.  Other columns are not
    read, so names cannot clash; repeated rows give repeated rows.
    """
    url = F.col(f"`{url_col}`")
    parsed = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    said = {rule.place: rule.verdict for rule in rules}
    verdict = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    for place, kind in said.items():
        verdict = F.when(F.col("rule") == place, kind).otherwise(verdict)
    scored = judge.score(parsed)
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")


def labelled_urls(spark: SparkSession, each: int = 5) -> DataFrame:
    """The labelled table ``word, host, path, verdict``: every word in ``each`` places, below 2,000 rows.

    A name without a meaning is allowed, since most hosts are ordinary and have one.
    """

    def listed(text: str) -> Column:
        return F.array(*[F.lit(x) for x in text.split()])

    def pick(text: str, at: Column) -> Column:
        return F.get(listed(text), F.pmod(at, F.lit(len(text.split()))).cast("int"))

    number = F.col("i") * each + F.col("k")
    row = spark.range(1)
    blocked = row.select(F.posexplode(listed(BLOCKED_WORDS)).alias("i", "word"), F.lit(BLOCK).alias("verdict"))
    plain = row.select(F.posexplode(listed(PLAIN_WORDS)).alias("i", "word"), F.lit(ALLOW).alias("verdict"))
    i = F.col("id")
    name = F.concat(pick(SYLLABLES, i * 7), pick(SYLLABLES, F.floor(i / 3) * 5 + 1), pick(SYLLABLES, i * 11 + 2))
    names = spark.range(NAMES).select(i.cast("int").alias("i"), name.alias("word"), F.lit(ALLOW).alias("verdict"))
    words = blocked.unionByName(plain).unionByName(names)
    places = words.select("*", F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("k"))
    host, path = pick(FRAMES, number), pick(PATHS, F.floor(number / 2) * 3 + F.col("k"))
    for mark, value in (("{w}", F.col("word")), ("{f}", pick(FILLERS, number * 3 + 1)), ("{t}", pick(ENDINGS, number * 2 + F.floor(number / 7)))):
        host = F.replace(host, F.lit(mark), value)
    path = F.replace(path, F.lit("{n}"), F.pmod(number * 37, F.lit(1000)).cast("string"))
    return places.select("word", host.alias("host"), path.alias("path"), "verdict")


def precision_recall(judge: UrlJudge, labelled: DataFrame) -> tuple[float, float]:
    """Of what the judge blocks in ``host, path, verdict``: the right share, and the share of all that are to be blocked."""
    said, meant = F.col("score") >= 0.5, F.col("verdict") == BLOCK
    r = judge.score(labelled).agg(F.count_if(said & meant).alias("hit"), F.count_if(said).alias("said"), F.count_if(meant).alias("meant")).first()
    return r["hit"] / max(1, r["said"]), r["hit"] / max(1, r["meant"])


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """A labelled URL table from the pages that a rule decides: ``host, path, verdict``."""
    url = F.col(f"`{url_col}`")
    parsed = pages.select(host_of(url).alias("host"), path_of(url).alias("path"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.place, r.verdict).otherwise(verdict)
    return parsed.withColumn("verdict", verdict).filter(F.col("verdict").isNotNull())
