"""Personal data: base patterns, and more spans by candidate gradient boosting.

Base spans come from four patterns with validators and always stay.  On top,
generators of high recall propose further spans, which may overlap: e-mail
addresses written out with "at" and "dot", telephone numbers of at least seven
digits without a plus, in any groups or in one, IPv6 addresses in full and
compressed, card numbers with other separators.  Every candidate is
described by features of its format and of the text around it; gradient
boosted trees, trained here on labelled snippets, score it, and a kind's
threshold, calibrated on snippets that the trees did not see, decides.
Selected candidates that overlap a base span, or a selected one of higher
score, are left out.

Everything runs in one pass over the texts without a shuffle: matches and the
pieces between them give positions, and the trees become one SQL expression.

The patterns are written so that Java matches them in time linear in the text
(possessive loops; a match starts at the start of a run or where the last
match ended) with the results of the plain forms.

Defined results: positions are code points, ends exclusive; a null or empty
text has no spans; a match that fails its validator is dropped and its text
not searched again.  Repeated rows, null ids and extra columns are kept as
they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: FIXED VALUES: kinds in their order, and the base patterns.
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: A telephone number starts neither within a number nor after its point or hyphen, and has seven digits.
NUMBER = r"(?<![0-9+]|[0-9][.-])(?=\(?[0-9](?:[\x20()./-]{0,4}[0-9]){6})"
HEX = r"[0-9A-Fa-f]{1,4}"
#: FIXED VALUES: generators of candidates: name, kind, pattern.
GENERATORS = [
    ("written email", "email",
     r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[({](?i:at)[\])}]\x20?|\x20(?i:at)\x20|@)[A-Za-z0-9-]++"
     r"(?:(?:\x20?[\[({](?i:dot)[\])}]\x20?|\x20(?i:dot)\x20|\.)[A-Za-z0-9-]++)++"),
    ("plain phone", "phone", r"(?<![0-9+.-])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}+[0-9]{2,5}){2,5}+(?![0-9])"),
    ("dialled phone", "phone", r"(?<![0-9+])00[1-9](?:[\x20().-]?+[0-9]){7,13}+(?![0-9])"),
    ("ipv6", "ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:{1,2}){2,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("other card", "card", r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){2}+[._/][0-9]{1,7}(?![0-9])"),
    ("evenly separated phone", "phone",
     NUMBER + r"\(?[0-9]{1,8}\)?([\x20./-])\(?[0-9]{1,9}\)?(?:\1[0-9]{1,9}){0,6}+(?![0-9])"),
    ("freely separated phone", "phone",
     NUMBER + r"\(?[0-9]{1,8}(?:(?:\)?[\x20./-]{1,2}\(?|\)|\()[0-9]{1,9}){1,7}+(?![0-9])"),
    ("two-part phone", "phone", NUMBER + r"\(?[0-9]{2,6}(?:\)[\x20./-]{0,2}|[\x20./-]{1,2})[0-9]{3,9}(?![0-9])"),
    ("bare phone", "phone", r"(?<![0-9A-Za-z+]|[0-9][.,-])[0-9]{7,15}(?![0-9A-Za-z])"),
    ("compressed ipv6", "ip",
     rf"(?<![0-9A-Za-z:.])(?:{HEX}(?::{HEX}){{0,6}}+::(?:{HEX}(?::{HEX}){{0,6}}+)?|::{HEX}(?::{HEX}){{0,6}}+)(?![0-9A-Za-z:])"),
    ("4-6-5 card", "card", r"(?<![0-9])[0-9]{4}[._/][0-9]{6}[._/][0-9]{4,5}(?![0-9])"),
]
#: FIXED VALUES: words before a span that speak for or against a kind.
SPEAKS = {
    "email": "mail|email|e-mail|contact|write|reach|address|to|me",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|whatsapp|dial|ring|text|sms|at|on",
    "ip": "ip|ipv6|host|server|address|ping|gateway|dns|from|client",
    "card": "card|visa|mastercard|amex|credit|debit|pay|paid|number|charge",
}
AGAINST = ("order|invoice|ref|reference|isbn|version|ver|page|pages|chapter|section|part|sku|serial|model|dated|date|"
           "score|ratio|lines|room|year|years|batch|ticket|meet|met|arrive|arrived|stop|look|sat|lot")
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at"
AROUND = 32
TREES, DEPTH, PRECISION, CHUNK = 20, 3, 0.97, 64


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def between(xs: Column, low: Column, end: Column) -> Column:
    """Elements ``low`` to ``end - 1``; ``slice`` would copy the whole array first."""
    return F.transform(F.sequence(low, end - 1), lambda i: F.get(xs, i))


def running(values: Column, join: Callable[[Column, Column], Column], start: Column) -> Column:
    """Array of longs of the running ``join`` (associative, ``start`` neutral)
    of an array of longs.  A fold copies its state at each element, so it runs
    over chunks of CHUNK elements, then over the chunks' last values."""
    def fold(xs: Column) -> Column:
        return F.aggregate(xs, F.array().cast("array<long>"), lambda a, x: F.concat(
            a, F.array(join(F.coalesce(F.get(a, F.size(a) - 1), start), x))))

    def chunked(xs: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int"))
        return F.transform(at, lambda c: fold(between(xs, c * CHUNK, F.least((c + 1) * CHUNK, F.size(xs)))))

    def joined(chunks: Column) -> Column:
        return bound(fold(F.transform(chunks, lambda c: F.get(c, F.size(c) - 1))), lambda upto: F.flatten(F.transform(
            chunks, lambda c, i: F.when(i == 0, c).otherwise(bound(F.get(upto, i - 1), lambda u: F.transform(c, lambda x: join(u, x)))))))

    return bound(values, lambda xs: F.when(F.size(xs) == 0, F.array().cast("array<long>")).otherwise(bound(chunked(xs), joined)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, text, before, after>> of all matches, from the
    matches and the pieces between them."""
    def spans(found: Column, pieces: Column) -> Column:
        lengths = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)),
                             lambda m, p: (F.char_length(p) + F.char_length(m)).cast("long"))
        return bound(running(lengths, lambda a, x: a + x, F.lit(0).cast("long")), lambda ends: F.transform(found, lambda m, i: bound(
            F.get(ends, i).cast("int"), lambda end: F.struct(
                (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("text"),
                F.right(F.get(pieces, i), F.lit(AROUND)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(8)).alias("after")))))

    empty = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")
    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, empty).otherwise(
        bound(F.split(text, pattern, -1), lambda pieces: spans(found, pieces))))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of at most 19 digits passes the Luhn check."""
    n = F.char_length(number)

    def term(i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), lambda a, i: a + term(i))
    return (n > 0) & (total % 10 == 0)


def valid(kind: str, text: Column) -> Column:
    n = F.char_length(digits(text))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return text.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits(text))).otherwise(F.lit(False))
    return n.between(9, 15)


def may_hold(kind: str, text: Column) -> Column:
    """A cheap test that every text with such a span passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


SPAN = "array<struct<kind:int,start:int,end:int>>"


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end>>, sorted by start, then kind."""
    out = []
    for k, kind in enumerate(KINDS):
        out.append(F.when(may_hold(kind, text), F.transform(_kept(text, kind), _as_span(k))).otherwise(F.array().cast(SPAN)))
    return _sorted(F.concat(*out))


def _kept(text: Column, kind: str) -> Column:
    return F.filter(matches(text, BASE[kind]), lambda m: valid(kind, m["text"]))


def _as_span(kind: int):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def _sorted(spans: Column) -> Column:
    """By start, then kind, then end: the natural order of structs in that order."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def describe(g: int, m: Column) -> list[Column]:
    """Features of a candidate of generator g: format first, then context."""
    kind = GENERATORS[g][1]
    text, before, after = m["text"], m["before"], m["after"]
    number = digits(text)
    n = F.char_length(number)
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    last = F.regexp_extract(before, r"([\p{L}-]+)[^\p{L}]*$", 1)
    return [
        F.lit(float(g)), n.cast("double"), F.char_length(text).cast("double"),
        F.char_length(F.regexp_replace(text, r"[^\x20().:/_-]", "")).cast("double"),
        flag(text.rlike(r"[\[({](?i:at|dot)[\])}]|@")), flag(text.rlike(r"(?i)[\]\s)}.](?:" + DOMAINS + r")$")),
        flag(F.when(n.between(12, 19), luhn(number)).otherwise(F.lit(False))),
        flag(text.rlike(r"^\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-][0-9]{4}$")), flag(n.between(9, 15)),
        flag(text.rlike(r"^(?:19|20)[0-9]{2}\D|\D(?:19|20)[0-9]{2}$")), flag(text.rlike("::|(?:[^:]+:){7}")),
        flag(F.lower(last).rlike("^(?:" + SPEAKS[kind] + ")$")), flag(F.lower(last).rlike("^(?:" + AGAINST + ")$")),
        flag(F.lower(before).rlike(r"(?:^|[^\p{L}])(?:" + SPEAKS[kind] + r")[^\p{L}]")), flag(before.rlike(r"(?:^|[\s:=,;(])$|^$")),
        flag(after.rlike(r"^(?:$|[\s.,;)!?])")), flag(F.lower(text).rlike(r"\sat\s.*\sdot\s")),
        flag(text.rlike(r"^\(?0[0-9]|^1[\x20./-]")), flag(after.rlike(r"^[\x20()./-]{1,2}[0-9]")),
    ]


PROPOSALS = "array<struct<kind:int,start:int,end:int,features:array<double>>>"
#: Every written address holds this; an IPv6 address holds a colon beside another or a hexadecimal digit, the rest a digit.
WRITTEN_AT = (r"(?i)[\[({]at[\])}]|@[a-z0-9-]++(?:\x20?[\[({]dot|\x20dot\x20)|"
              r"\x20at\x20[a-z0-9-]++(?:\.[a-z0-9-]|\x20?[\[({]dot|\x20dot\x20)")


MAY_PROPOSE = {"email": WRITTEN_AT, "ip": "[0-9A-Fa-f:]:|:[0-9A-Fa-f:]", "card": "[0-9]", "phone": "[0-9]"}


def proposed(text: Column) -> Column:
    """array<struct<kind, start, end, features>> of all generators."""
    kinds = {name: i for i, name in enumerate(KINDS)}
    out = []
    for g, (_, kind, pattern) in enumerate(GENERATORS):
        may = text.rlike(MAY_PROPOSE[kind])
        found = F.transform(matches(text, pattern), _proposal(g, kinds[kind]))
        out.append(F.when(may, found).otherwise(F.array().cast(PROPOSALS)))
    return F.concat(*out)


def _proposal(g: int, kind: int):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                              F.array(*describe(g, m)).alias("features"))


#: FIXED VALUES: labelled snippets by kind; # is any digit, $ any letter, * any hexadecimal digit.
SNIPPETS = {
    ("email", 1): [
        "mail me: $$$$ at $$$$$$ dot com", "contact $$$.$$$$ [at] $$$$$ [dot] org today", "write to $$$$ (at) $$$$$.net now",
        "reach me $$$$## at $$$$ dot co dot uk", "e-mail $$$$_$$ {at} $$$$$$ {dot} de", "address $$$$ [at] $$$$$$$.com, thanks",
        "my email is $$$$$$ at $$$$$ dot fr.", "send it to $$$ [AT] $$$$ [DOT] io"],
    ("email", 0): [
        "we look at home.then we go", "they met at noon dot and left", "she sat at $$$$.$$$$$ with us", "arrived at $$$$ dot $$$$$$ again",
        "stop at $$$$$$.$$$ for lunch", "the $$$$$ at $$$$$.$$$$$$ was", "a lot at $$$$ dot $$$$$", "years at $$$$$$$.$$$$ and more"],
    ("phone", 1): [
        "call ###-###-####", "phone: (###) ###-####", "tel ###.###.#### please", "mobile ## ## ## ## ##", "my number, call 0049 ## #######",
        "fax 00## ### ### ###", "dial 0033 # ## ## ## ##", "text me on ##### ######", "ring ### ### #### after six", "call us at (##) #### ####",
        "call #-###-###-####", "dial # (###) ###-#### now", "mobile 0#### ######", "phone 0## #######", "tel 0##/#######, please",
        "phone (0##)####### today", "call ##########", "mobile 0##########, thanks", "whatsapp ########## after six", "fax ###-####",
        "ring 0### ###### or write", "phone: 1-800-###-####"],
    ("phone", 0): [
        "order ###-###-####-##", "isbn ###-##-###-##", "version ##.##.##", "pages ##-##-##", "dated 20##-##-## ##", "score ##-##-##",
        "serial 00########", "ref ##/##/####", "batch ####-####-####-####", "lines ## ## ## ## ## ##", "on ##.##.20## we", "ticket 00##########",
        "order ##########", "invoice ######## is paid", "serial ############", "ref ####### done", "years 20##-20##", "isbn #-###-#####-#",
        "isbn ##########", "lot 0#### ######", "score ###-####", "model ### ####", "about ######## people", "it counts ########## bytes",
        "lines # ### ### ###", "version #.###.###.####", "sku #-###-###-####", "part 0## #######", "a sum of ### ###### in all"],
    ("ip", 1): [
        "host 20**:*db#:**::****", "ping fe80::****:****:****:****", "server ****:****:****:****:****:****:****:****",
        "client ip 2a0#:***::*", "from ****:***:****:****::**", "address ::ffff:****:**** 2001:db8:#::#",
        "ping fe80::#", "host ::#", "server 2001:db8::", "gateway fe80::****, then", "dns 2001:db8:**::", "client ::ffff:****:0#*#"],
    ("ip", 0): [
        "at ##:##:## sharp", "time ##:##:##", "ratio #:#:#", "mac **:**:**:**:**:**", "score ##:##:##:##", "verse #:##:##",
        "class dad::add", "type abc::fed", "model bed::", "call face::cab() there", "see ::add and"],
    ("card", 1): [
        "card 4111.1111.1111.1111", "visa 4012.8888.8888.1881", "pay 5555.5555.5555.4444", "credit card 3530.1113.3330.0000",
        "debit 6011.1111.1111.1117", "number 4000_0566_5566_5556", "charge 5105/1051/0510/5100",
        "amex 3782.822463.10005", "card 3714_496353_98431", "pay 3787/344936/71000"],
    ("card", 0): [
        "serial ####.####.####.####", "invoice ####_####_####_####", "batch ####/####/####/###", "ref ####.####.####.#",
        "sku ####_####_####_####", "model ####.####.####.##",
        "serial ####.######.#####", "batch ####_######_#####", "ref ####/######/####"],
}
COPIES = 30


def snippets(spark: SparkSession) -> DataFrame:
    """(copy, text, kind, label): every snippet filled in COPIES times."""
    kinds = {name: i for i, name in enumerate(KINDS)}
    rows = [F.struct(F.lit(t).alias("form"), F.lit(kinds[kind]).alias("kind"), F.lit(label).alias("label"))
            for (kind, label), forms in SNIPPETS.items() for t in forms]
    table = spark.range(COPIES, numPartitions=1).select(F.col("id").alias("copy"), F.inline(F.array(*rows)))
    pick = lambda i, n: F.pmod(F.xxhash64("form", "copy", i), F.lit(n)).cast("int") + 1
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"

    def fill(c: Column, i: Column) -> Column:
        return (F.when(c == "#", F.substring(F.lit("0123456789"), pick(i, 10), F.lit(1)))
                .when(c == "$", F.substring(F.lit(letters), pick(i, 26), F.lit(1)))
                .when(c == "*", F.substring(F.lit("0123456789abcdef"), pick(i, 16), F.lit(1))).otherwise(c))

    return table.select("copy", F.array_join(F.transform(F.split("form", ""), fill), "").alias("text"), "kind", "label")


class Scorer:
    """Boosted trees as one SQL expression, with a threshold by kind."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    @staticmethod
    def _node(node: tuple, x: Column) -> Column:
        if len(node) == 1:
            return F.lit(node[0])
        feature, edge, left, right = node
        return F.when(F.get(x, F.lit(feature)) <= edge, Scorer._node(left, x)).otherwise(Scorer._node(right, x))

    def probability(self, x: Column) -> Column:
        total = reduce(lambda a, b: a + b, [F.lit(w) * self._node(t, x) for t, w in zip(self.trees, self.weights, strict=True)])
        return 1 / (1 + F.exp(-2 * total))

    def admits(self, kind: Column, p: Column) -> Column:
        out = F.lit(False)
        for k, edge in self.thresholds.items():
            out = out | ((kind == k) & (p >= edge))
        return out


def _tree(node) -> tuple:
    """A fitted tree's node as nested tuples."""
    if node.numDescendants() == 0:
        return (float(node.prediction()),)
    return (int(node.split().featureIndex()), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def train(spark: SparkSession) -> Scorer:
    """Fit on four fifths of the filled-in snippets; on the rest, choose each
    kind's lowest threshold at which PRECISION of its selections are right.  A
    part of a longer candidate of its kind counts as wrong."""
    longer = lambda o, c: ((o["kind"] == c["kind"]) & (o["start"] <= c["start"]) & (o["end"] >= c["end"])
                           & (o["end"] - o["start"] > c["end"] - c["start"]))
    rows = snippets(spark).select("copy", F.col("kind").alias("k"), "label", proposed(F.col("text")).alias("all"))
    rows = rows.select("copy", "k", "label", "all", F.explode("all").alias("c")).where(F.col("c.kind") == F.col("k"))
    whole = ~F.exists("all", lambda o: longer(o, F.col("c")))
    rows = rows.select("copy", "k", (F.col("label") * whole.cast("int")).cast("double").alias("label"),
                       array_to_vector("c.features").alias("features"))
    rows = rows.coalesce(1).persist()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, maxBins=16).fit(rows.where(F.col("copy") % 5 != 0))
    trees = [_tree(t._java_obj.rootNode()) for t in model.trees]
    scorer = Scorer(trees, list(model.treeWeights), {})
    held = rows.where(F.col("copy") % 5 == 0).select(
        "k", "label", scorer.probability(vector_to_array("features")).alias("p")).collect()
    rows.unpersist()
    for k in range(len(KINDS)):
        for edge in sorted({r["p"] for r in held if r["k"] == k and r["p"] >= 0.5}):
            chosen = [r["label"] for r in held if r["k"] == k and r["p"] >= edge]
            if sum(chosen) >= PRECISION * len(chosen):
                scorer.thresholds[k] = edge
                break
    return scorer


def clear(spans: Column, cover: Column) -> Column:
    """The ``spans`` (structs that start with start, end) that overlap none of
    ``cover`` (array of struct<start, end>).  Both are sorted together; a span
    is clear if what starts before it ends before it, and what starts after it
    starts after its end."""
    long = lambda c: c.cast("long")
    least, most = F.lit(-1).cast("long"), F.lit(2**62)
    both = F.sort_array(F.concat(
        F.transform(cover, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.lit(None).cast("int").alias("at"))),
        F.transform(spans, lambda c, i: F.struct(c["start"].alias("start"), c["end"].alias("end"), i.alias("at")))))

    def free(xs: Column) -> Column:
        """Places in ``spans`` of those that are clear."""
        ends = running(F.transform(xs, lambda x: F.when(x["at"].isNull(), long(x["end"])).otherwise(least)), F.greatest, least)
        starts = F.reverse(running(F.transform(F.reverse(xs), lambda x: F.when(x["at"].isNull(), long(x["start"])).otherwise(most)),
                                   F.least, most))
        return bound(ends, lambda before: bound(starts, lambda after: F.transform(
            F.filter(xs, lambda x, i: x["at"].isNotNull() & (F.get(before, i) <= x["start"]) & (F.get(after, i) >= x["end"])),
            lambda x: x["at"])))

    return F.when((F.size(cover) == 0) | (F.size(spans) == 0), spans).otherwise(
        bound(both, lambda xs: bound(free(xs), lambda places: F.transform(places, lambda i: F.get(spans, i)))))


def best_of_overlaps(chosen: Column) -> Column:
    """The spans that overlap no better one: of higher p, then first, longest,
    of the first kind.  Only spans that a chain of overlaps connects are
    compared; sorted by start, such a group ends where the next start is not
    before any end so far."""
    clash = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    better = lambda x, y: F.when(x["p"] != y["p"], x["p"] > y["p"]).otherwise(
        F.when(x["start"] != y["start"], x["start"] < y["start"]).otherwise(
            F.when(x["end"] != y["end"], x["end"] > y["end"]).otherwise(x["kind"] < y["kind"])))

    def alone(group: Column) -> Column:
        return F.filter(group, lambda c: ~F.exists(group, lambda o: clash(o, c) & better(o, c)))

    def groups(xs: Column) -> Column:
        """Each group, cut at the places where one starts."""
        ends = running(F.transform(xs, lambda x: x["end"].cast("long")), F.greatest, F.lit(-1).cast("long"))
        return bound(ends, lambda upto: bound(
            F.filter(F.sequence(F.lit(0), F.size(xs) - 1), lambda i: (i == 0) | (F.get(upto, i - 1) <= F.get(xs, i)["start"])),
            lambda cuts: F.flatten(F.transform(cuts, lambda c, i: bound(
                between(xs, c, F.coalesce(F.get(cuts, i + 1), F.size(xs))), alone)))))

    return bound(F.sort_array(chosen), lambda xs: F.when(F.size(xs) < 2, xs).otherwise(groups(xs)))


def find(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, base, spans): base and all spans of every whole text, as
    arrays of struct<kind, start, end> by start, then kind."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    scored = F.transform("more", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), scorer.probability(c["features"]).alias("p")))
    rows = rows.select("doc_id", "base", proposed(F.col("text")).alias("more")).select("doc_id", "base", scored.alias("scored"))
    chosen = F.filter("scored", lambda c: scorer.admits(c["kind"], c["p"]))
    rows = rows.select("doc_id", "base", bound(chosen, lambda c: clear(c, F.col("base"))).alias("chosen"))
    added = F.transform(best_of_overlaps(F.col("chosen")), lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.when(F.size("chosen") == 0, F.col("base")).otherwise(
        _sorted(F.array_distinct(F.concat("base", added)))).alias("spans"))


def listing(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), train(spark))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                        F.sha2(listing(F.col("base")), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))
