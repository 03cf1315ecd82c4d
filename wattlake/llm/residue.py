"""Template residue, filler and failure messages, localised by likelihood-ratio windows.

Four Kneser-Ney models over characters are fitted: one of filler and unfilled template fields, one of
error and blocking notices, and one of natural wording. The first two learn from fixed expressions
and from a small grammar that writes template fields and dummy Latin; the natural model learns from
the data itself, without what the models of the round before called residue. A text is read once by
all models; the stretch with the largest likelihood ratio of a residue class against natural wording
localises the residue, its length against the text's is the coverage. A text is a case if the
stretch is sure enough; coverage is given beside it, so a caller may ask for a whole or a part.

Nulls and blank texts are no cases. Texts are read whole. Repeated rows each have their own result.
"""

from __future__ import annotations

import json
import random
import re
import string
import unicodedata
from collections import Counter
from collections.abc import Iterator
from http import HTTPStatus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattlake.llm.lm import KneserNey, best_windows, coded, corpus_empty, corpus_grams, pieces, spans, tables_of
from wattlake.session import cut_lineage, let_go, spread

CLASSES = ["filler", "error", "plain"]

# Words of dummy Latin.
LATIN = """lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud ullamco laboris nisi aliquip ex ea commodo
duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
aliquam vestibulum mauris donec nunc pharetra turpis porta massa vitae ornare facilisi""".split()
# Names of template fields.
FIELDS = """name|title|state|amount|product|price|date|city|utility|company|program|segment|email|phone|address|zip|url|description|heading|first name|program name|program title|utility company|utility name|customer segment
customer name|rebate amount|rebate amt|offer title|item label|item name|page heading|page title|site name|company name|start date|end date|contact email|row name|your name|product name|category""".replace("\n", "|").split("|")
# Marks around template fields; @ stands for the field.
MARKS = """{{@}}|{{ @ }}|{@}|${@}|<%= @ %>|<?= $row['@'] ?>|<?php echo $@; ?>|%@%|%%@%%|{% @ %}|[[@]]|[@]|[insert @]|[@ here]|[your @]|[add @ here]|<@ goes here>|<insert @>|<@>|__@__|##@##|#@#|@@F@@|«@»|$@$|{{{@}}}|[%@%]""".split("|")
# Common wording of office and site software where an editor is to write something, and of values that stand for nothing.
FILLER = """your title here|your text here|your name here|insert title here|insert text here|add title|add text here|add your text here|enter text here|enter title here|type here|sample text|sample page|sample document
placeholder|placeholder text|this is placeholder text|this is a sample page|dummy text|text goes here|title goes here|content goes here|description goes here|replace this text|edit this text|click to add title
click to add text|click here to edit|untitled|untitled document|untitled page|untitled (copy)|new page|page (copy)|copy of page|heading|tbd|tba|to be determined|to be announced|to be completed|coming soon|under construction
test|test page|test test|testing testing|foo bar|foo|asdf|asdf asdf|qwerty|xxx|xxxx|xxxxxxxx|abc abc|null|undefined|none|nan|n/a n/a|null null|none none|nan nan|undefined undefined|[object object]""".replace("\n", "|").split("|")
# Common wording of failed, refused and blocked requests, beside the names that the protocol has for them.
NOTICES = """page not found|oops!|oops! something went wrong|something went wrong|an unexpected error occurred|an error occurred while processing your request|the page you requested could not be found
the page you are looking for might have been removed, had its name changed, or is temporarily unavailable.|we can't find the page you're looking for|sorry, this page isn't available|this page no longer exists
please try again later|site under maintenance|down for maintenance|scheduled maintenance|we'll be right back|connection timed out|connection refused|connection reset by peer|upstream request timeout
upstream connect error or disconnect/reset before headers|access denied|permission denied|you don't have permission to access this resource|request blocked|sorry, you have been blocked|attention required!
just a moment...|checking your browser before accessing|checking if the site connection is secure|verify you are human|verifying you are human. this may take a few seconds.|please enable cookies
please enable javascript to continue|you need to enable javascript to run this app.|please enable javascript in your browser|this site requires javascript|javascript is required|javascript is disabled
your browser does not support javascript|enable scripts in your browser|scripting is turned off|your session has expired|session expired|please log in to continue|sign in to continue|rate limit exceeded
fatal error: uncaught exception|unhandled exception|stack trace|database connection failed|could not connect to server|record not found|failed to load resource|no response from server|request failed""".replace("\n", "|").split("|")


def notices() -> list[str]:
    """Examples of failure messages: the protocol's own names and explanations of failures, as pages show them, and the common wording."""
    out = list(NOTICES) + [f.format(404) for f in ("{}", "error {}", "{} error", "http {}", "http error {}", "status {}", "code {}", "{} page not found")]
    for s in HTTPStatus:
        if s >= 400:
            name = s.phrase
            out += [name, f"{s.value} {name}", f"{s.value} - {name}", f"error {s.value}: {name}", f"http {s.value} {name}", *([s.description] if s.description else [])]
    return [fold(x) for x in out]


_NUMBER = re.compile(r"\d[\d.,]*")
#: What stands for a number, and for one that the protocol has for a failed request.
PLAIN_NUMBER, FAILURE = "0", "4"
_CODES = {str(s.value): FAILURE for s in HTTPStatus if s >= 400}


def _number(m: re.Match) -> str:
    n = m[0]
    return _CODES.get(n) or _CODES.get(n.rstrip(".,"), PLAIN_NUMBER)


def fold(text: str) -> str:
    """A text in lower case and compatibility forms, with one sign for a number and another for the code of a failure."""
    t = (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()
    return " ".join(_NUMBER.sub(_number, t).split())


def _fields() -> list[str]:
    out = []
    for f in FIELDS:
        w = f.split()
        out += [" ".join(w), "_".join(w), "".join(w), ".".join(w), "-".join(w)]
    return sorted(set(out))


def grammar(seed: int = 11, latin: int = 400) -> list[str]:
    """Examples of residue: each template field in each mark, and dummy Latin."""
    rng = random.Random(seed)
    fields = _fields()
    out = []
    for m in MARKS:
        inner = m.replace("@@F@@", "\x00")
        for f in fields:
            out.append(inner.replace("@", f) if "\x00" not in inner else f"@@{f}@@")
    for f in FIELDS:
        out += [f"{f} nan", f"{f} - undefined", f"null null {f}", f"undefined {f}", f"{f} null", f"{f} tbd", f"{f} tba", f"{f} to be determined"]
    for w in ("nan", "null", "undefined", "none"):
        out += [x for c in string.ascii_lowercase for x in (f"{c} {w}", f"{c} - {w}")] * 3
    for _ in range(latin):
        out.append(" ".join(rng.choice(LATIN) for _ in range(rng.randint(2, 14))) + rng.choice(["", "."]))
    return out


#: Order of the n-grams whose joint frequencies are compared.
JOINT = 5
#: Joint log-ratio a character from which a text is kept out of the natural model's first fit, and marks of template fields that keep it out.
LEAK = 0.3
MARKED = re.compile(r"\{\{|\}\}|\$\{|<[%?]|\{[a-z_. ]+\}|\[\[|\[(?:insert|your|add) |\[[a-z_. ]{3,}\](?![a-z])|[<\[][^<>\[\]]{1,30} (?:goes )?here[>\]]|%%?[a-z_. ]+%|@@|#[a-z_. ]+#|__[a-z]|«|»|\b(?:null|undefined|nan)\b")


#: What stands in every text that MARKED, or DUMMY, finds: looked for first, as that is much faster.
_SIGNS = ("{", "}", "[", "<", "%", "@@", "#", "__", "«", "»", "null", "undefined", "nan")
_DUMMIES = ("NaN", "undefined", "null", "[object")


def marked(text: str) -> bool:
    """Whether a folded text bears the marks of a template field or a dummy value."""
    return any(x in text for x in _SIGNS) and MARKED.search(text) is not None


def dummy(text: str) -> bool:
    """Whether a dummy value stands in a text in its exact spelling."""
    return any(x in text for x in _DUMMIES) and DUMMY.search(text) is not None


def seeds() -> tuple[list[str], list[str]]:
    """The texts that the models of filler and of notices learn from."""
    return [f"{x} " for x in grammar()] + [f"{x} " for x in FILLER] * 8, [f"{x} " for x in notices()] * 8


def at_home(model: KneserNey, texts: list[str]) -> np.ndarray:
    """Whether each folded text bears no mark of a template field and is more at home in natural wording, by joint frequencies."""
    keep = np.array([not marked(x) for x in texts])
    for lo, hi in pieces(texts):
        c, owner = coded(texts[lo:hi], model.order)
        size = np.array([len(x) for x in texts[lo:hi]])
        for ratio in model.joint_ratios(c, CLASSES[:2], "plain", JOINT):
            keep[lo:hi] &= np.bincount(owner[owner >= 0], ratio[owner >= 0], hi - lo) < LEAK * size
    return keep


def fit(natural: list[tuple[str, int]], rounds: int = 2, order: int = 6, own: int = 2, bits: int = 20) -> KneserNey:
    """The models, from natural wording with its frequency; it may hold some residue itself.

    First what is more at home in a residue class is kept out, by joint frequencies; then the models
    choose once more for themselves.
    """
    filler, error = seeds()
    texts = [f"{fold(x)} " for x, _ in natural]
    times = [max(1, min(int(n), 10)) for _, n in natural]
    keep = np.ones(len(texts), bool)

    def build() -> KneserNey:
        plain = [x for x, n, k in zip(texts, times, keep, strict=True) if k for _ in range(n)]
        return KneserNey(CLASSES, order, own, bits).fit({"filler": filler, "error": error, "plain": plain or [" "]})

    model = build()
    if texts:
        keep &= at_home(model, texts)
    for _ in range(rounds):
        model = build()
        if texts:
            keep &= stretches(model, texts)[0] < THRESHOLD
    return model


DRIFT = 0.3
#: Windowed log-likelihood ratio from which a text counts as a case.
THRESHOLD = 14.0
#: A lower ratio is enough where the residue covers the text to this share, if the text has so many characters at least: two letters are a code of something.
WHOLE, COVERAGE, SHORTEST = 9.0, 0.5, 3
#: So is one from here on, if a value that programs write for a missing one stands in the text in its exact spelling.
WEAK = 4.0
#: Evidence that one character gives at most, half of a case: a character never met after a common beginning is the rarer the larger the corpus, so that in a large one it alone
#: would make a case of a wording that was kept out of the natural model. The sign for the code of a failure stands for so many digits.
SINGLE, CODE = THRESHOLD / 2, 3
DUMMY = re.compile(r"(?<![\w])(?:NaN|undefined|null|\[object Object\])(?![\w])")


def stretches(model: KneserNey, texts: list[str], drift: float = DRIFT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each folded text the largest windowed log-likelihood ratio of a residue class, the class (0 filler, 1 error) and the length of the window."""
    if not texts:
        return np.zeros(0), np.zeros(0, int), np.zeros(0, int)
    out = []
    for lo, hi in pieces(texts):
        c, owner = coded(texts[lo:hi], model.order)
        g, parts = np.minimum(model.gains(c, owner, drift), np.where(c == ord(FAILURE), CODE * SINGLE, SINGLE).astype(np.float32)), spans(owner, hi - lo)
        found = [best_windows(g[j], owner, hi - lo, parts) for j in range(2)]
        score = np.stack([f[0] for f in found])
        k, at = score.argmax(axis=0), np.arange(hi - lo)
        out.append((score[k, at], k, np.stack([f[2] - f[1] + 1 for f in found])[k, at]))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(3))


#: How often a text counts in the natural model at most, in a corpus of so many texts or fewer; in a larger one, as many times more as that is larger.
OFTEN, CORPUS = 10, 400_000


def wordings(texts: DataFrame, text: Column, most: int | None = OFTEN) -> DataFrame:
    """(t, n): every distinct text, numbers aside, of whatever length, with its frequency (``most`` at most, if given)."""
    folded = texts.select(text.cast("string").alias("t")).where("trim(t) <> ''").mapInArrow(_folded, "t string, n bigint")
    n = F.sum("n") if most is None else F.least(F.sum("n"), F.lit(most))
    return folded.groupBy("t").agg(n.cast("bigint").alias("n"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts folded and counted, each once a batch."""
    for b in batches:
        n = Counter(f"{fold(x)} " for x in b.column(0).to_pylist())
        n.pop(" ", None)
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["t", "n"])


def _told(texts: DataFrame, model: KneserNey, joint: bool) -> DataFrame:
    """The wordings with ``gone``: whether they are residue, by marks and joint frequencies if ``joint``, else by what ``stretches`` finds."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            t = b.column(0).to_pylist()
            if t:
                gone = ~at_home(m, t) if joint else stretches(m, t)[0] >= THRESHOLD
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(gone)], ["t", "n", "gone"])

    out = cut_lineage(texts.mapInArrow(run, "t string, n bigint, gone boolean"))
    shared.destroy()
    return out


def fit_all(texts: DataFrame, text: Column, rounds: int = 2, order: int = 6, own: int = 2, bits: int = 20) -> KneserNey:
    """The models of ``fit``, whose natural wording is counted in Spark over all texts, not over a sample.

    The n-grams are counted once; what a round finds to be residue is taken off again. From ``CORPUS`` texts on
    frequencies are shares, as many times ``CORPUS``: the thresholds hold for a corpus of that size, and in larger ones
    frequent wording would lose its share to the rest and be taken for residue.
    """
    seed = dict(zip(CLASSES, (*seeds(), [" "]), strict=True))
    others = [t for y in CLASSES[:2] for t in seed[y]]
    rest = cut_lineage(spread(wordings(texts, text, None)))
    times = max(1.0, (rest.agg(F.sum("n")).first()[0] or 0) / CORPUS)
    rest = rest.withColumn("n", F.least("n", F.lit(int(OFTEN * times)).cast("bigint")))
    grams = corpus_grams(rest, others, order, own)
    model = KneserNey(CLASSES, order, own, bits)
    first = tables_of(grams, order, own, bits, only=JOINT, times=times)
    if first is None:
        return model.fit(seed)
    model.take(seed, "plain", *first)
    for i in range(rounds):
        told = _told(rest, model, joint=i == 0)
        rest = told.where("not gone").select("t", "n")
        grams = corpus_grams(grams, others, order, own, less=told.where("gone"))
        model = model.counted("plain", *(tables_of(grams, order, own, bits, times=times) or corpus_empty(order)))
        let_go(texts.sparkSession)
    return model


def score(df: DataFrame, keys: tuple[str, ...], text: str, model: KneserNey) -> DataFrame:
    """(*keys, residue, kind, coverage, found) of each row with a text.

    A weaker stretch counts too if the text holds a dummy value in its exact spelling.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    d = spread(df.where(F.col(text).isNotNull()).select(*keys, F.col(text).cast("string").alias("__text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            raw = b.column(b.num_columns - 1).to_pylist()
            folded = [f"{fold(t)} " for t in raw]
            lo, chars = 0, 0
            for i in range(len(folded) + 1):
                if i == len(folded) or chars > 150_000:
                    part = folded[lo:i]
                    r, k, n = stretches(m, part)
                    cover = np.minimum(n / np.array([max(len(x) - 1, 1) for x in part]), 1.0)
                    size = np.array([len(x.strip()) for x in raw[lo:i]], np.int64)
                    weak = np.array([dummy(x) for x in raw[lo:i]], bool)
                    found = (r >= THRESHOLD) | (weak & (r >= WEAK)) | ((r >= WHOLE) & (cover >= COVERAGE) & (size >= SHORTEST))
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(lo, i - lo) for c in b.columns[:-1]), pa.array(r), pa.array([CLASSES[x] for x in k]), pa.array(cover), pa.array(found)],
                        [*b.schema.names[:-1], "residue", "kind", "coverage", "found"],
                    )
                    lo, chars = i, 0
                if i < len(folded):
                    chars += len(folded[i])

    return d.mapInArrow(run, f"{schema}, residue double, kind string, coverage double, found boolean")


def json_leaves(df: DataFrame, id_: str, raw: str) -> DataFrame:
    """(id, text): every string value in the JSON of each row; what isn't whole JSON is one text."""

    def strings(x: object) -> Iterator[str]:
        if isinstance(x, str):
            yield x
        elif isinstance(x, dict):
            for v in x.values():
                yield from strings(v)
        elif isinstance(x, list):
            for v in x:
                yield from strings(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = [], []
            for key, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                try:
                    found = list(strings(json.loads(t)))
                except ValueError:
                    found = [t]
                ids += [key] * len(found)
                texts += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "text"])

    return df.select(F.col(id_).cast("string").alias("id"), F.col(raw).alias("raw")).mapInArrow(run, "id string, text string")
