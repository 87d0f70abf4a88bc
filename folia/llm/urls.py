"""URL filters: host and path rules, and logistic regression on hashed character n-grams."""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import mix, slices

#: Hashed features, n-gram lengths, and the most rows that a labelled table may have.
BUCKETS, GRAMS, MAX_LABELLED, MAX_RULES = 1 << 18, (3, 4, 5), 100_000, 1_000

#: Parts of a url with the weight of each.
PARTS = {"h": 1.0, "p": 0.5}

#: Words of hosts and paths that are to be blocked: gambling, adult, pills, quick money, piracy, fakes, tracking and fraud.
BLOCK_WORDS = """
casino casinos bet bets betting bookie bookmaker gamble gambler gambling jackpot jackpots poker pokerroom roulette slot slots slotmachine lotto lottery
lotteries baccarat blackjack wager wagers wagering freespin freespins spins bingo adult adults porn porno pornstar xxx xxxtube sex sexy sexcam sexchat
escort escorts hookup hookups camgirl camgirls nude nudes naked erotic erotica fetish livesex pill pills viagra viagras cialis levitra pharma cheaprx
rxmeds meds cheapmeds steroid steroids tramadol xanax slimming slimpills weightloss dietpill dietpills loan loans payday paydayloans lender cash quickcash
fastcash easymoney moneyfast badcredit forex forexbot cryptobot doubler richquick earnfast warez crack cracks cracked keygen keygens serials torrent
torrents nulled pirate pirated leaked freedownload replica replicas rolex fakeid fakewatch fakes knockoff knockoffs counterfeit cheap cheapest cheapbags
ads adsnetwork adnetwork adnetworks adserver adservers adserving adtrack adclick track tracker tracking popunder popups click clicks clickbait clicknow spam spammer spams linkfarm farm backlink backlinks
buytraffic prize prizes winner winners win winnow giveaway giveaways freegift freegifts claim claimnow phish phishing malware free freebie bonus bonuses
""".split()

#: Words of other hosts and paths.
ALLOW_WORDS = """
academy archive art astronomy atlas audio bakery biology bird book books botany bridge bulletin calendar camera castle cat centre chemistry chess
choir church cinema city climate club code college community compiler concert cooking council culture cycle cycling dance data database design
developer dictionary docs drama earth ecology economy editor education energy engine english family festival film fish flora forest forum foundation
gallery garden gardens gazette geography geology grammar guide harbour health heritage hiking history hospital house institute island journal
journals kernel kitchen lake language law learn lesson letters library linux literature local magazine maps market math mathematics medicine
memory mill mountain museum music nature network news newspaper observatory ocean opera orchard orchestra paper parish park people philosophy
photo physics picture pilot planet poem poetry police post project public quarterly radio railway recipe recipes record research review river
road rocket root sailing school science sea society software source space sport station stone story street student studio study summer surgery
survey system systems teacher technology temple theatre times today tools town trade trail translation travel tree university valley village
vision volunteer walking water weather wiki wildlife winter women wood workshop world writer yacht zoo
""".split()

#: Harmless words that hold a word to be blocked.
ALLOW_WORDS += """
adsorption adulthood alphabet better between beta caterpillar cashew cashmere cheapside claimant clicker darwin diabetes escorted essex farmers
farmhouse freedom freeman freestyle freeway freeze godwin loanword middlesex pillar pillow pirates prizewinning sextant sextet slotted soundtrack
spinster sussex tibet tracks trackway window windows winnipeg winston
""".split()

#: Public hosts of projects, schools and offices.
ALLOW_HOSTS = """
apache.org archive.org arxiv.org bbc.co.uk berkeley.edu bl.uk cam.ac.uk cern.ch cpan.org cran.r-project.org crates.io debian.org docs.python.org
doi.org duckdb.org ed.ac.uk eff.org ethz.ch europa.eu fedoraproject.org gcc.gnu.org git-scm.com github.com gitlab.com golang.org gov.uk gutenberg.org
haskell.org ieee.org ietf.org iso.org jstor.org kde.org kernel.org llvm.org loc.gov maven.apache.org metoffice.gov.uk mit.edu mozilla.org nasa.gov
nature.com netbsd.org nih.gov noaa.gov npmjs.com nytimes.com openstreetmap.org ox.ac.uk parliament.uk postgresql.org princeton.edu pypi.org
readthedocs.io rust-lang.org si.edu spark.apache.org sqlite.org stanford.edu theguardian.com unesco.org usgs.gov vim.org w3.org who.int wordpress.org
""".split()

#: Ends of hosts: of either kind, and of blocked ones more often.
_ENDS, _CHEAP_ENDS = "com net org com net org com org io co.uk de fr es info eu example.com example.net example.org".split(), "xyz top click biz ru online site win".split()
_SUBDOMAINS = ["", "", "", "www.", "www.", "blog.", "m.", "shop.", "en."]


def labelled_urls(block_words: Iterable[str] = BLOCK_WORDS, allow_words: Iterable[str] = ALLOW_WORDS, each: int = 24, seed: int = 4) -> list[tuple[str, int]]:
    """A labelled table made by rule from two word lists: (url, 1 to block or 0).

    Hosts join a word with others of its list, neutral parts or harmless words,
    plain or with hyphens, under ends that both kinds share and some that
    blocked hosts favour.  Other hosts are public ones and names made of syllables.  Paths
    are neutral in most rows; in some the words stand in the path, behind a
    name made of syllables.
    """
    rng = random.Random(seed)
    neutral = "24 4u 99 365 best big buy get home hub in info line live my new now one online plus shop site star store super the top web world zone".split()
    kinds = ["", "/", "/{l}/{n}", "/{l}/{n}/", "/{l}/{n}.html", "/{n}", "/index.html", "/page/{n}", "/{y}/{n}/"]

    def name() -> str:
        heads, tails = ["b", "bl", "br", "c", "ch", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "st", "t", "th", "tr", "v", "w", ""], ["", "", "l", "n", "nd", "nt", "r", "rs", "s", "sh", "st", "t", "th", "tion", "ble", "ly"]
        return "".join(rng.choice(heads) + rng.choice("aeiou") + rng.choice(tails) for _ in range(rng.choice((1, 2, 2, 3))))

    def path() -> str:
        return rng.choice(kinds).format(l=rng.choice(("en", "de", "fr", "es")), n=rng.randrange(1, 10 ** rng.randrange(2, 7)), y=rng.randrange(1998, 2026))

    def mixed(words: list[str], first: str, joiners: list[str]) -> str:
        # a word to be blocked stands beside any words
        parts = [first, *(rng.choice(rng.choice((words, words, neutral, others))) for _ in range(rng.choice((0, 1, 1, 2))))]
        rng.shuffle(parts)
        return rng.choice(joiners).join(parts)

    out, others = [], list(allow_words)
    for label, words, ends, joiners in ((1, list(block_words), [*_ENDS, *_CHEAP_ENDS], ["-", "-", ""]), (0, list(allow_words), _ENDS, ["-", "", ""])):
        for word in words:
            for k in range(each):
                if k % 4 == 3:  # the words stand in the path of some other host
                    out.append((f"https://{rng.choice(_SUBDOMAINS)}{name()}.{rng.choice(_ENDS)}/{mixed(words, word, ['-', '-', '/', '_'])}{path()}", label))
                else:
                    out.append((f"http{'s' * (k % 2)}://{rng.choice(_SUBDOMAINS)}{mixed(words, word, joiners)}.{rng.choice(ends)}{path()}", label))
    out += [(f"https://{rng.choice(('', 'www.'))}{h}{path()}", 0) for h in ALLOW_HOSTS for _ in range(each // 2)]
    out += [(f"https://{rng.choice(_SUBDOMAINS)}{name()}{rng.choice(('', '', '-' + name()))}.{rng.choice(_ENDS)}{path()}", 0) for _ in range(150 * each)]
    return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host after the first ``://``, A-Z lower-cased, and path up to ``?`` or ``#``; else empty."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    stop = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:stop]


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the distinct hashed character n-grams of many hosts and paths.

    A part's values have the length PARTS, however long it is.  Marks stand at
    the ends of a host and at the end of a path, and tell the two apart.
    """
    found = []
    for k, (weight, parts) in enumerate(zip(PARTS.values(), ([f"^{h}$" for h in hosts], [f"{p}$" for p in paths]), strict=True)):
        size = np.array([len(x) for x in parts], np.int64)
        char = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(len(parts)), size)
        end = np.cumsum(size)[row]
        at, gram = np.arange(len(char)), np.full(len(char), k + 1, np.uint64)
        keys = []
        for n in range(1, max(GRAMS) + 1):
            gram = gram * np.uint64(0x100000001B3) + np.append(char[n - 1 :], np.zeros(min(n - 1, len(char)), np.uint64))
            if n in GRAMS:
                fit = at + n <= end
                keys.append(row[fit] * BUCKETS + (mix(gram[fit]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        key = np.unique(np.concatenate(keys))
        row, col = np.divmod(key, BUCKETS)
        found.append((row, col, weight / np.sqrt(np.bincount(row, minlength=len(parts)))[row]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@dataclass
class UrlModel:
    """Weights of a logistic regression; BUCKETS floats, whatever the data."""

    weights: np.ndarray
    bias: float
    threshold: float = 0.5

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        row, col, value = features(hosts, paths)
        return 1 / (1 + np.exp(-(self.bias + np.bincount(row, self.weights[col] * value, len(hosts)))))

    def score(self, host: str, path: str) -> float:
        return float(self.scores([host], [path])[0])


def train_url_model(labelled: Iterable[tuple[str, int]] | DataFrame | None = None, l2: float = 1e-7, steps: int = 400, rate: float = 1.0, prior: float = 0.4) -> UrlModel:
    """Fits on a small labelled table of (url, label), at most MAX_LABELLED rows; built-in if None.

    ``prior`` is the weight of all rows to block in the loss, so a url without
    any known n-gram scores below one half.
    """
    if isinstance(labelled, DataFrame):
        labelled = [tuple(r) for r in labelled.limit(MAX_LABELLED + 1).collect()]
    rows = list(labelled_urls() if labelled is None else labelled)
    if not 0 < len(rows) <= MAX_LABELLED:
        raise ValueError(f"a labelled table has 1 to {MAX_LABELLED} rows")
    y = np.array([float(v) for _, v in rows])
    row, col, value = features(*map(list, zip(*(host_and_path(u) for u, _ in rows), strict=True)))
    used, col = np.unique(col, return_inverse=True)
    each = np.where(y > 0, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum()))
    w, b = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    sum_w = np.full(len(used), 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[col] * value, len(y)) + b)))
        g = np.bincount(col, ((p - y) * each)[row] * value, len(used)) + l2 * w
        sum_w += g * g
        w -= rate * g / np.sqrt(sum_w)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return UrlModel(weights, b)


@cache
def _built_in() -> UrlModel:
    return train_url_model()


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = (), model: UrlModel | None = None, url_col: str = "url") -> DataFrame:
    """Judges every url by the longest rule that fits it, else by the model.

    A rule is (``host/path start``, ``block`` or ``allow``): it fits its host
    and all subdomains if the url's path starts with its path.

    Returns the columns of ``pages`` with ``host``, ``path``, ``rule`` (null if
    none fits), ``score`` (of the model, between 0 and 1) and ``verdict``,
    which replace columns of these names.  A null url, or one without ``://``,
    has empty host and path; without any n-gram its score is the model's prior
    (0.4 in the built-in one), so it is allowed.  Urls of any length are read
    whole.  Repeated rows get a verdict each; null ids and other columns pass
    as they are; an empty table gives an empty table.

    Weights and rules are parameters of bounded size (BUCKETS, MAX_RULES) that
    travel with the tasks; nothing is shuffled.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    model = model or _built_in()
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(-1 + batch.num_columns)):
                part = batch.slice(lo, hi - lo)
                host, path = (part.column(part.num_columns - k).to_pylist() for k in (2, 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sent.value.scores(host, path))], [*part.schema.names, "__score"])

    url = F.coalesce(F.col(url_col), F.lit(""))
    # of a url without :// the pattern finds nothing, and both parts are empty
    part = lambda k: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    host = F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parsed = pages.select("*", host.alias("__host"), part(2).alias("__path"))
    scored = parsed.mapInArrow(judge, T.StructType([*parsed.schema.fields, T.StructField("__score", T.DoubleType())]))
    host, path = F.col("__host"), F.col("__path")
    fits = []
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)))
    fit = F.coalesce(*fits) if fits else F.lit(None).cast("string")
    action = reduce(lambda c, r: c.when(F.col("rule") == r[0], F.lit(r[1])), rules, F.when(F.lit(False), F.lit("")))
    own = F.when(F.col("score") >= model.threshold, F.lit("block")).otherwise("allow")
    named = scored.drop("host", "path", "rule", "score", "verdict").withColumns({"host": host, "path": path, "rule": fit, "score": F.col("__score")})
    return named.withColumn("verdict", F.coalesce(action, own)).drop("__host", "__path", "__score")
