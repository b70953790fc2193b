"""Personal data by candidate gradient boosting, in built-in functions.

Base rules (exact patterns with checks) find emails, IP addresses, payment
cards and phone numbers; these spans always stay. High-recall generators
propose further, overlapping spans: any run of digits with loose separators, tight card
and phone forms inside such runs, and any email-like text. Each candidate gets small integer features of its
format (digits, groups, separators, signs) and context (characters and key
words around it). Boosted trees of depth two score the candidates; a candidate
that no base span touches is added when its score passes the threshold.

Training needs no labelled spans: a candidate that touches a base span is a
weak positive, any other a weak negative, and the checks themselves (Luhn sum,
octet range, length of a number) are not features. Tight forms are told apart by
one: a base pattern takes as many digits as it can and does not retry, so a card
beside another number fails as a whole; its tight form (sixteen digits in fours
whose Luhn sum is right; a whole phone number) is learnt from those that stand
alone. What defines a base span must not decide for loose forms, so each email and
phone number found counts again in the forms that the base patterns miss
(``views``: "(at)" and "(dot)" with and without spaces, a number without '+',
country code or separators, in the same context).
All candidates of the corpus are counted per distinct feature
vector, at most the product of the features' ranges; the trees are fitted on
that table in the driver, on one half of the documents (by hash). The threshold
of each kind is calibrated on the other half: going down the scores, levels are
pooled until they hold MIN_SUPPORT candidates, and it stops before the first pool
whose own precision is below ``precision``. So sure candidates higher up cannot
carry doubtful ones along, and a few doubtful ones at the top do not end it.

Positions are code points. A pattern's matches and the text between them (split
by the same pattern) alternate, so positions are running sums of lengths. The
patterns use possessive quantifiers where giving back cannot help and start
only where a run of their first characters starts, so no text makes them slow.

Defined results: null and empty texts have no spans (``redact`` leaves them as
they are); texts are read whole; repeated rows are treated alike; an empty
table gives no rows; other columns are ignored (``redact`` passes them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import fresh, whole_text, written

# Fixed patterns of the base kinds, in their order.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these cannot match.
NEEDS = {"email": ["@"], "ip": ["."], "card": [], "phone": ["+"], "number": [], "address": ["@", "(at)", "[at]"],
         "sixteen": [], "line": ["+"]}
GENERATORS = {
    "number": r"[+]?+[(]?+[0-9](?:[\x20().-]{0,2}+[0-9]){5,}+",
    "address": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?+(?:@|\(at\)|\[at\]) ?+[{_DOMAIN}]++"
               rf"(?: ?+(?:\.|\(dot\)|\[dot\]) ?+[{_DOMAIN}]++)*+",
    "sixteen": r"(?<![0-9])[0-9]{4}(?:[\x20-]?+[0-9]{4}){3}(?![0-9])",
    "line": r"\+[0-9]{1,3}[\x20.-]?+\(?+[0-9]{2,4}\)?+[\x20.-]?+[0-9]{3}[\x20.-]?+[0-9]{4}(?![0-9])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = 24
WORDS = {1: "call|phone|tel|mobile|fax|dial", 2: "card|visa|amex|account|iban|pay", 3: "id|no|nr|number|token|key|order|isbn",
         4: "ip|host|addr|server", 5: "mail|contact|write"}
SPAN = "start:int,end:int,body:string"
FOUND = f"array<struct<{SPAN},before:string,after:string>>"
MIN_SUPPORT = 20       # candidates of a pool of score levels
FEATURES = ["digits", "groups", "plus", "parens", "dots", "dashes", "before", "after", "word", "shape", "tight"]


def matches(text: Column, name: str, pattern: str, context: bool = False) -> Column:
    """array<struct<start, end, body[, before, after]>> of the leftmost
    non-overlapping matches."""
    gaps, bodies = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = FOUND if context else f"array<struct<{SPAN}>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["body"]), F.lit(0))
        fields = [start.alias("start"), end.alias("end"), x["body"].alias("body")]
        if context:
            fields += [F.lower(F.right(x["gap"], F.lit(CONTEXT))).alias("before"),
                       F.left(F.coalesce(x["next"], F.lit("")), F.lit(1)).alias("after")]
        out = F.when(x["body"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(*fields))))
        return F.struct(end.alias("pos"), out.alias("out"))

    zipped = F.arrays_zip(gaps.alias("gap"), bodies.alias("body"),
                          F.slice(gaps, F.lit(2), F.size(gaps)).alias("next")) if context else \
        F.arrays_zip(gaps.alias("gap"), bodies.alias("body"))
    names = ["gap", "body", "next"] if context else ["gap", "body"]
    items = zipped.cast("array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")
    none = F.array().cast(kind)
    found = F.aggregate(items, F.struct(F.lit(0).alias("pos"), none.alias("out")), step, lambda a: a["out"])
    needs = NEEDS[name]
    if not needs:
        return found
    possible = F.contains(text, F.lit(needs[0]))
    for n in needs[1:]:
        possible = possible | F.contains(text, F.lit(n))
    return F.when(possible, found).otherwise(none)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    padded, total = F.lpad(digits, 19, "0"), F.lit(0)
    for i in range(19):
        d = F.substring(padded, i + 1, 1).cast("int")
        total = total + (F.when(d > 4, 2 * d - 9).otherwise(2 * d) if (18 - i) % 2 else d)
    return total % 10 == 0


def _passes(kind: str, body: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return body.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.length(_digits(body))
    if kind == "phone":
        return n.between(10, 15)
    return F.when(n.between(14, 19), _luhn(_digits(body))).otherwise(False)


def base_spans(text: Column, kind: str) -> Column:
    """array<struct<start, end, kind>> (kind: its place in KINDS)."""
    kept = F.filter(matches(text, kind, PATTERNS[kind]), lambda m: _passes(kind, m["body"]))
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def _bucket(x: Column, limits: list[int]) -> Column:
    """How many of the limits ``x`` exceeds."""
    out = F.lit(0)
    for n in limits:
        out = out + (x > n).cast("int")
    return out


def _character(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"^[\x20\x09-\x0D]$"), 1).when(c.rlike("^[0-9]$"), 2) \
        .when(c.rlike(r"^[.,;:!?)\]\"'(\[=<>]$"), 3).otherwise(4)


def _candidate(m: Column, generator: str) -> Column:
    body, count = m["body"], lambda c: F.length(body) - F.length(F.translate(body, c, ""))
    digits = F.length(_digits(body))
    word = F.lit(0)
    for code, words in reversed(WORDS.items()):
        word = F.when(m["before"].rlike(rf"(?:^|[^a-z])(?:{words})[a-z]{{0,3}}[^a-z]{{0,6}}$"), code).otherwise(word)
    feats = {
        "digits": _bucket(digits, [0, 6, 9, 10, 12, 13, 15, 16, 19]),
        "groups": _bucket(F.size(F.split(body, r"[^0-9A-Za-z]+")), [1, 2, 3, 4, 5]),
        "plus": F.least(count("+"), F.lit(1)),
        "parens": F.least(count("()[]"), F.lit(2)),
        "dots": F.least(count("."), F.lit(4)),
        "dashes": F.least(count("- "), F.lit(3)),
        "before": _character(F.right(m["before"], F.lit(1))),
        "after": _character(m["after"]),
        "word": word,
        "shape": F.when(count("@") > 0, 2).when(body.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), 1).otherwise(0),
        "tight": F.lit(int(generator in ("sixteen", "line"))),
    }
    own = {"address": "email", "sixteen": "card", "line": "phone"}
    kind = F.lit(KINDS.index(own[generator])) if generator in own else \
        F.when(feats["shape"] == 1, KINDS.index("ip")).when(digits >= 13, KINDS.index("card")) \
        .otherwise(KINDS.index("phone"))
    return F.struct(m["start"].alias("start"), kind.cast("int").alias("kind"), m["end"].alias("end"),
                    *[feats[n].cast("int").alias(n) for n in FEATURES])


def _candidates(text: Column, generator: str) -> Column:
    found = matches(text, generator, GENERATORS[generator], True)
    if generator == "sixteen":
        found = F.filter(found, lambda m: _luhn(_digits(m["body"])))
    return F.transform(found, lambda m: _candidate(m, generator))


def _touches(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))


def find(df: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """``df`` with its base spans (sorted) and its candidates, and the names
    of these two columns."""
    base, cand = fresh(df, "pii_base"), fresh(df, "pii_candidates")
    t = whole_text(text)
    out = df.withColumn(base, F.array_sort(F.concat(*[base_spans(t, k) for k in KINDS])))
    found = F.concat(*[_candidates(t, g) for g in GENERATORS])
    marked = F.transform(found, lambda c: c.withField("touches", _touches(c, F.col(base))))
    return out.withColumn(cand, marked), base, cand


# -- boosted trees ----------------------------------------------------------
class Trees:
    """Depth-two trees: [(feature, limit, four leaf values and inner tests)]."""

    def __init__(self):
        self.start, self.trees, self.limits = 0.0, [], {}

    def margin(self, value) -> object:
        """Sum of the leaves; ``value(name)`` is a Column or a number."""
        total = F.lit(self.start) if isinstance(value(FEATURES[0]), Column) else self.start
        for tree in self.trees:
            total = total + _leaf(tree, value)
        return total


def _leaf(tree, value):
    if isinstance(tree, float):
        return F.lit(tree) if isinstance(value(FEATURES[0]), Column) else tree
    name, limit, low, high = tree
    test = value(name) <= limit
    a, b = _leaf(low, value), _leaf(high, value)
    return F.when(test, a).otherwise(b) if isinstance(test, Column) else (a if test else b)


def _grow(cells: list, depth: int, rate: float, l2: float):
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = -rate * g / (h + l2)
    if depth == 0 or len(cells) < 2:
        return leaf
    best = (1e-6, None, None)
    for k in range(len(FEATURES)):
        by: dict[int, list[float]] = {}
        for x, cg, ch in cells:
            s = by.setdefault(x[k], [0.0, 0.0])
            s[0] += cg
            s[1] += ch
        lg = lh = 0.0
        for v in sorted(by)[:-1]:
            lg, lh = lg + by[v][0], lh + by[v][1]
            gain = lg * lg / (lh + l2) + (g - lg) ** 2 / (h - lh + l2) - g * g / (h + l2)
            if gain > best[0]:
                best = (gain, k, v)
    _, k, v = best
    if k is None:
        return leaf
    low, high = [c for c in cells if c[0][k] <= v], [c for c in cells if c[0][k] > v]
    return FEATURES[k], v, _grow(low, depth - 1, rate, l2), _grow(high, depth - 1, rate, l2)


def boost(table: dict[tuple, tuple[int, int]], rounds: int = 30, rate: float = 0.3, l2: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; ``table``: feature vector ->
    (positives, candidates)."""
    model = Trees()
    pos, n = sum(p for p, _ in table.values()), sum(c for _, c in table.values())
    if not pos or pos == n:
        model.start = -20.0 if not pos else 20.0
        return model
    model.start = math.log(pos / (n - pos))
    margin = {x: model.start for x in table}
    for _ in range(rounds):
        cells = []
        for x, (p, c) in table.items():
            q = 1 / (1 + math.exp(-margin[x]))
            cells.append((x, c * q - p, c * q * (1 - q)))
        tree = _grow(cells, 2, rate, l2)
        if isinstance(tree, float):
            break
        model.trees.append(tree)
        for x in margin:
            margin[x] += _leaf(tree, dict(zip(FEATURES, x)).__getitem__)
    return model


def views(kind: int, x: tuple) -> list[tuple]:
    """Feature vectors of an email's or phone number's candidate, had it been
    written in forms that the base patterns do not match."""
    f = dict(zip(FEATURES, x))
    if KINDS[kind] == "email" and f["shape"] == 2:
        more = min(f["groups"] + 1, 5)                    # the word "at"
        all_words = min(f["groups"] + 1 + f["dots"], 5)   # and "dot"
        forms = [{"dashes": max(f["dashes"], 2)}]
        for spaces in (False, True):
            wide = {"dashes": 3} if spaces else {}
            near = {"dashes": max(f["dashes"], 2)} if spaces else {}
            forms += [{"shape": 0, "parens": 2, "groups": more} | near,
                      {"shape": 0, "parens": 2, "groups": all_words, "dots": 0} | wide]
    elif KINDS[kind] == "phone" and f["plus"]:
        # a leading sign or bracket starts an empty group
        less, least = max(f["groups"] - 1, 0), max(f["groups"] - 2, 0)
        local = {"plus": 0, "digits": max(f["digits"] - 1, 3), "dashes": max(f["dashes"] - 1, 0)}
        forms = [{"plus": 0, "groups": less}, {"plus": 0, "groups": less, "parens": 0}, local | {"groups": less},
                 local | {"groups": least, "parens": 0}]
        if f["word"] == 1:  # digits alone say little without such a word before them
            bare = {"plus": 0, "parens": 0, "dots": 0, "dashes": 0, "groups": 0}
            forms += [bare, bare | {"digits": local["digits"]}]
    else:
        return []
    return list(dict.fromkeys(tuple((f | form).values()) for form in forms))


def calibrate(levels: dict[float, list[int]], precision: float) -> float:
    """The lowest score to add; ``levels``: score -> [positives, candidates]."""
    limit, pos, n = math.inf, 0, 0
    lowest = min(levels, default=0.0)
    for score in sorted(levels, reverse=True):
        pos, n = pos + levels[score][0], n + levels[score][1]
        if n < MIN_SUPPORT and score > lowest:
            continue
        if pos < precision * n:
            break
        limit, pos, n = score, 0, 0
    return limit


def fit(found: DataFrame, cand: str, text: str = "text", precision: float = 0.9) -> Trees:
    fold = F.pmod(F.xxhash64(whole_text(text)), F.lit(2))
    rows = found.select(fold.alias("fold"), F.explode(cand).alias("c"))
    counts = rows.groupBy("fold", "c.kind", *[f"c.{n}" for n in FEATURES]).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("c.touches").cast("int")).alias("pos")).collect()
    cells = [(r.fold, r["kind"], tuple(r[n] for n in FEATURES), r.pos, r.n) for r in counts]
    cells += [(fold, kind, v, pos, pos) for fold, kind, x, pos, _ in cells if pos for v in views(kind, x)]
    learn: dict[tuple, tuple[int, int]] = {}
    for fold, _, x, pos, n in cells:
        if fold == 0:
            a, b = learn.get(x, (0, 0))
            learn[x] = (a + pos, b + n)
    model = boost(learn)
    for kind in range(len(KINDS)):
        by_score: dict[float, list[int]] = {}
        for fold, of, x, pos, n in cells:
            if fold == 1 and of == kind:
                seen = by_score.setdefault(model.margin(dict(zip(FEATURES, x)).__getitem__), [0, 0])
                seen[0] += pos
                seen[1] += n
        model.limits[kind] = calibrate(by_score, precision)
    return model


def added_spans(base: Column, cand: Column, model: Trees) -> Column:
    """Candidates over their kind's threshold that touch no base span; of
    overlapping ones the best scored stays."""
    scored = F.transform(F.filter(cand, lambda c: ~c["touches"]), lambda c: F.struct(
        (-model.margin(lambda n: c[n])).alias("order"), c["start"].alias("start"), c["kind"].alias("kind"),
        c["end"].alias("end")))
    passes = F.filter(scored, lambda c: _over(c, model))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def take(acc: Column, c: Column) -> Column:
        span = F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
        return F.when(_touches(c, acc), acc).otherwise(F.concat(acc, F.array(span)))

    return F.aggregate(F.array_sort(passes), empty, take)


def _over(c: Column, model: Trees) -> Column:
    ok = F.lit(False)
    for kind, limit in model.limits.items():
        if limit < math.inf:
            ok = ok | ((c["kind"] == kind) & (-c["order"] >= F.lit(limit - 1e-9)))
    return ok


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _detected(df: DataFrame, text: str, precision: float) -> tuple[DataFrame, str, str]:
    """(rows with spans, name of the base column, name of the all-spans column)"""
    found, base, cand = find(df, text)
    found = written(df.sparkSession, found, "pii-found")
    model = fit(found, cand, text, precision)
    spans = fresh(found, "pii_spans")
    every = F.array_sort(F.concat(F.col(base), added_spans(F.col(base), F.col(cand), model)))
    return found.withColumn(spans, every).drop(cand), base, spans


def detect(df: DataFrame, key: str = "doc_id", text: str = "text", precision: float = 0.9) -> DataFrame:
    """One row per document: key, base and spans (array<struct<start, kind,
    end>>, kind a place in KINDS, sorted by start and kind)."""
    rows = df.select(F.col(key).alias("pii_key"), F.col(text).alias("pii_text"))
    out, base, spans = _detected(rows, "pii_text", precision)
    return out.select(F.col("pii_key").alias(key), F.col(base).alias("base"), F.col(spans).alias("spans"))


def redact(df: DataFrame, text: str = "text", precision: float = 0.9) -> DataFrame:
    """The rows and columns of ``df``; each span of the text (overlapping ones
    together) is replaced by the name of its kind in brackets."""
    out, _, spans = _detected(df, text, precision)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    t = F.col(text)

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.array(F.substr(t, acc["pos"] + 1, s["start"] - acc["pos"]), tags[s["kind"]]))
        new = s["start"] >= acc["pos"]
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(new, more).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(spans, start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substr(t, a["pos"] + 1, F.length(t))))
    return out.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(t)).select(*df.columns)
