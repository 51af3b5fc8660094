"""Personal data: fixed patterns, and spans that weak supervision adds.

Four kinds have a pattern and a check and are always taken.  Candidates for the others come in families: tokens that mix
letters and digits, numbers that are long or follow a word for a number of identity, tokens without digits that follow a word
for a secret (all three kind `secret`), names that a gazetteer or a title begins, and street addresses.  Labelers vote on
them: patterns of the candidate, gazetteers of words in or before it, and the context.
For each family expectation-maximisation estimates from the counts of vote patterns how reliable each labeler is and how likely a candidate
with these votes is personal.  A classifier over the token's shape is then trained on those likelihoods and decides.

Everything that touches texts is a column expression; votes and features reach the driver as counts of their patterns, of
which there are at most 3 ** labelers and 2 ** features.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, settled, text_or_empty

# The kinds in their order.  The patterns find what the plain ones would; they start at the previous match or at
# the beginning of a run and give nothing back, so that long runs cost one walk and no stack.
KINDS = ["email", "ip", "card", "phone", "secret", "name", "address"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without a match of this has none of the pattern
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
TOKEN = r"(?:\G|(?<![^\x20\x09-\x0D]))(?=[^\x20\x09-\x0D0-9]*+[0-9])[^\x20\x09-\x0D]++"
SECRET_WORDS = ["password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "credential", "ssn", "iban", "private_key"]
PLAIN_WORDS = ["version", "license", "licensed", "chapter", "page", "section", "figure", "table", "year", "volume", "edition", "no", "number"]
ID_WORDS = [*SECRET_WORDS, "social security", "passport", "passcode", "passphrase", "pin", "account", "acct", "routing", "tax id", "licence", "driver'?s license", "medical record"]
GIVEN = ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Peter", "Paul", "Andrew",
         "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Anna", "Maria", "Emma", "Laura", "Julia",
         "Hans", "Klaus", "Stefan", "Jean", "Pierre", "Marie", "Claire", "Carlos", "Jose", "Juan", "Luis", "Carmen", "Sofia", "Mohammed", "Ahmed", "Fatima", "Wei", "Yuki"]
TITLES = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame)\.?"
STREETS = "(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Square|Court|Way)"
CAPITAL = r"[A-Z\u00C0-\u00DE][A-Za-z\u00C0-\u024F'-]++"
# a word for an identity or a secret, what may link it to the value, and the mark or blank between
LINK = r"(?:\x20(?:number|no|id|code)\b\.?)?+(?:\x20(?:is|was)\b)?+"
TOLD = r"(?i:(?<![A-Za-z0-9_])(?:" + "|".join(ID_WORDS) + ")" + LINK + r"(?:[\x20\x09]?[:=#][\x20\x09]?|[\x20\x09]))"
WORD = TOLD + r"++[^\x20\x09-\x0D]++"
NAME = rf"(?<![A-Za-z0-9_])(?:{TITLES}\x20{CAPITAL}|(?:{'|'.join(GIVEN)})(?:\x20[A-Z]\.)?\x20{CAPITAL})(?:\x20{CAPITAL})?"
ADDRESS = rf"(?<![A-Za-z0-9_])[0-9]{{1,6}}[A-Za-z]?\x20(?:{CAPITAL}\x20){{1,3}}{STREETS}\b"
ADDED = {"token": (TOKEN, "[0-9]"), "word": (WORD, r"(?i)(?<![A-Za-z0-9_])(?:" + "|".join(ID_WORDS) + r")[\x20\x09:=#]"),
         "name": (NAME, NAME), "address": (ADDRESS, rf"[0-9][A-Za-z]?\x20[A-Z\u00C0-\u00DE]")}
MIXED, NUMBER, PLAIN, PERSON, PLACE = range(5)
RANKS = [4, 4, 4, 5, 6]
BLOCK = 64


def with_matches(df: DataFrame, text: Column, patterns: dict[str, tuple[str, str]], names: dict[str, str]) -> DataFrame:
    """`df` with a column for each kind of pattern: (start, end, body, before) of its matches in `text`.

    `patterns` has a pattern and a hint for each kind; a text without a match of the hint has none of the pattern.  Places are
    running sums of the lengths of matches and of what lies between them, taken in blocks, so that many matches in a text do
    not cost the square of their number.  Steps are columns of their own, computed once.
    """
    step = lambda kind, what: free_name(df, f"{names[kind]}_{what}")
    # by place, as slice() copies the array it is taken from
    total = lambda values, a, z: F.aggregate(F.sequence(a, z), F.lit(0).cast("long"), lambda sum_, j: sum_ + F.get(values, j))
    made: dict[str, list[str]] = {k: [step(k, x) for x in ("found", "gaps", "sizes", "blocks")] for k in patterns}
    col = {k: [F.col(f"`{x}`") for x in v] for k, v in made.items()}
    out = settled(df, {made[k][0]: F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(p), F.lit(0))) for k, (p, hint) in patterns.items()})
    out = settled(out, {made[k][1]: F.when(F.size(col[k][0]) > 0, F.split(text, p, -1)) for k, (p, _) in patterns.items()})

    def sizes_of(found, gaps):
        return F.transform(found, lambda m, i: (F.length(m) + F.length(F.get(gaps, i))).cast("long"))

    def blocks_of(sizes):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")),
                           lambda b: total(sizes, b * BLOCK, F.least(b * BLOCK + BLOCK, F.size(sizes)) - 1))

    out = settled(out, {made[k][2]: F.when(F.size(col[k][0]) > 0, sizes_of(*col[k][:2])) for k in patterns})
    out = settled(out, {made[k][3]: F.when(F.size(col[k][0]) > 0, blocks_of(col[k][2])) for k in patterns})

    def run(kind):
        found, gaps, sizes, blocks = col[kind]

        def place(m, i):
            block = F.floor(i / BLOCK).cast("int")
            end = F.when(block > 0, total(blocks, F.lit(0), block - 1)).otherwise(F.lit(0).cast("long")) + total(sizes, block * BLOCK, i)
            return F.struct(end.alias("end"), m.alias("body"), F.right(F.get(gaps, i), F.lit(40)).alias("before"))
        return F.coalesce(F.when(F.size(found) > 0, F.transform(F.transform(found, place), lambda r: F.struct(
            (r.end - F.length(r.body)).alias("start"), r.end.alias("end"), r.body.alias("body"), r.before.alias("before")))), F.array().cast(NO_RUNS))
    out = settled(out, {names[k]: run(k) for k in patterns})
    return out.drop(*(x for v in made.values() for x in v))


NO_RUNS = "array<struct<start:bigint,end:bigint,body:string,before:string>>"


def digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    turned = F.split(F.reverse(number), "")
    value = lambda c, i: F.when(i % 2 == 0, c).when(c > 4, 2 * c - 9).otherwise(2 * c)
    total = F.aggregate(F.transform(F.filter(turned, lambda c: c != ""), lambda c, i: value(c.cast("int"), i)), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def valid(kind: str, body: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(body, r"\."), lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) > 3, False).otherwise(
            F.coalesce(F.expr("1") * F.nullif(F.ltrim(p, F.lit("0")), F.lit("")).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        size = F.length(digits(body))
        return F.when(size.between(12, 19), luhn(digits(body))).otherwise(False)
    if kind == "phone":
        return F.length(digits(body)).between(9, 15)
    return F.lit(True)


def with_spans(docs: DataFrame, text: Column, base: str, tokens: str) -> DataFrame:
    """`docs` with the base spans (start, rank, end), ordered, and the candidates (start, end, body, before, family).

    `rank` is the kind's place in KINDS.  Candidates are without outer marks and do not touch a base span: tokens with a letter
    and a digit, numbers of seven digits or more or after one of ID_WORDS, tokens without a digit after one, names, addresses.
    """
    names = {k: free_name(docs, f"{base}_{k}") for k in [*KINDS[:4], *ADDED]}
    raw, t = free_name(docs, f"{base}_text"), F.col(f"`{free_name(docs, f'{base}_text')}`")
    out = with_matches(settled(docs, {raw: text_or_empty(text)}), t, {**{k: (PATTERNS[k], HINTS[k]) for k in KINDS[:4]}, **ADDED}, names)

    def kept(rank, kind):
        return F.transform(F.filter(F.col(f"`{names[kind]}`"), lambda m: valid(kind, m.body)),
                           lambda m: F.struct(m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end")))

    out = settled(out, {base: F.sort_array(F.concat(*(kept(r, k) for r, k in enumerate(KINDS[:4]))))})
    def told(m):
        head = F.regexp_extract(m.body, f"^{TOLD}++", 0)
        return F.struct((m.start + F.length(head)).alias("start"), F.substring(m.body, F.length(head) + 1, F.length(m.body)).alias("body"), head.alias("before"))

    def trimmed(found):
        inner = F.transform(found, lambda m: F.struct(m.start.alias("start"), F.regexp_replace(m.body, r"[^A-Za-z0-9]++$", "").alias("body"), m.before.alias("before")))
        body = F.transform(inner, lambda m: F.struct((m.start + F.length(m.body)).alias("end"), F.regexp_replace(m.body, r"^[^A-Za-z0-9]++", "").alias("body"), m.before.alias("before")))
        return F.transform(body, lambda m: F.struct((m.end - F.length(m.body)).alias("start"), m.end.alias("end"), m.body.alias("body"), m.before.alias("before")))

    def of(found, family):
        return F.transform(found, lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), m.body.alias("body"), m.before.alias("before"), family(m).alias("family")))

    touches = lambda m: F.exists(F.col(f"`{base}`"), lambda b: (b.start < m.end) & (m.start < b.end))
    col = {k: F.col(f"`{names[k]}`") for k in ADDED}
    number = lambda m: m.body.rlike("[0-9]") & ((F.length(digits(m.body)) >= 7) | m.before.rlike(TOLD + r"[^A-Za-z0-9]{0,2}$"))
    tokens_ = F.filter(trimmed(col["token"]), lambda m: m.body.rlike("[0-9]") & (m.body.rlike("[A-Za-z]") | number(m)))
    words = F.filter(trimmed(F.transform(col["word"], told)), lambda m: m.body.rlike("[A-Za-z]") & ~m.body.rlike("[0-9]"))
    found = F.concat(of(tokens_, lambda m: F.when(m.body.rlike("[A-Za-z]"), MIXED).otherwise(NUMBER)), of(words, lambda m: F.lit(PLAIN)),
                     of(col["name"], lambda m: F.lit(PERSON)), of(col["address"], lambda m: F.lit(PLACE)))
    out = settled(out, {tokens: F.filter(found, lambda m: ~touches(m))})
    return out.drop(raw, *names.values())


def words_pattern(words: list[str]) -> str:
    return "(?i)(?:" + "|".join(words) + ")"


def votes(m: Column) -> Column:
    """One letter for each of the family's labelers: p for personal, n for not, a for no opinion."""
    body, before, size = m.body, m.before, F.length(digits(m.body))
    told, marked = before.rlike(TOLD + r"[^A-Za-z0-9]{0,2}$"), before.rlike(r"(?i)(?:[:=#]|\b(?:is|was|number|no\.?))[^A-Za-z0-9]{0,3}$")
    number = [
        # context: a word for an identity before it, with a mark; patterns: social security; few digits; dates, amounts, decimals
        F.when(told, "p"), F.when(told & marked, "p"), F.when(body.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "p"), F.when(size < 4, "n"),
        F.when(body.rlike(r"^(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}|[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+\.[0-9]+|[0-9]{4}-[0-9]{4})$"), "n"),
        F.when(before.rlike(words_pattern(PLAIN_WORDS) + r"[\s.,]{1,3}$") & ~told, "n"),
        F.when(~told & ~body.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "n")]
    plain = [
        # context: a mark, or only a blank, before it; patterns: its length, mixed case or marks; a gazetteer of words that follow in prose
        F.when(marked, "p"), F.when(~marked, "n"), F.when(~marked & body.rlike("^[a-z]+$"), "n"), F.when(F.length(body) < 5, "n"), F.when(marked & (F.length(body) >= 8), "p"),
        F.when(body.rlike("[a-z][A-Z]|[^A-Za-z]"), "p"),
        F.when(body.rlike(r"(?i)^(?:required|invalid|incorrect|wrong|correct|missing|protected|expired|changed|reset|optional|encrypted|unknown|empty|stored|not|the|an?|your|must|should|for|and|or|to|in|of|is|was|number|none|null)$"), "n")]
    person = [
        # gazetteers: a title, a given name, words of places and firms; context: words before names; patterns: three words, months
        F.when(body.rlike(rf"^{TITLES}\x20"), "p"), F.when(body.rlike(rf"(?:^|\x20)(?:{'|'.join(GIVEN)})\x20"), "p"),
        F.when(before.rlike(r"(?i)(?:name|named|name is|dear|contact|signed|from|by|met|called)[:,]?\x20$"), "p"),
        F.when(body.rlike(rf"\x20(?:{STREETS}|Inc|Ltd|University|College|Company|Bank|Hospital|Airport|River|Bridge)$"), "n"),
        F.when(body.rlike(r"\x20(?:January|February|March|April|May|June|July|August|September|October|November|December)$"), "n"),
        F.when(body.rlike(r"(?:\x20.*){2}"), "p"), F.lit("a")]
    place = [
        # patterns: a house number, a long number; context: words before addresses; gazetteers: street words
        F.when(body.rlike("^[0-9]{1,4}[A-Za-z]?\\x20"), "p"), F.when(body.rlike("^[0-9]{5,}"), "n"), F.when(before.rlike(r"(?i)(?:address|lives?|living|at|home|resid\w+)[:,]?\x20$"), "p"),
        F.when(body.rlike(rf"\x20{STREETS}$"), "p"), F.when(before.rlike(words_pattern(PLAIN_WORDS) + r"[\s.,]{1,3}$"), "n"), F.lit("a"), F.lit("a")]
    labelers = [
        # patterns: a key with a fixed prefix; a long run of mixed letters and digits; an ordinal, a unit, a version
        F.when(body.rlike(r"(?:AKIA|ASIA|ghp_|xox[bp]-|sk-)[A-Za-z0-9_-]{10,}"), "p"),
        F.when(body.rlike(r"[A-Za-z0-9_]{14,}") & body.rlike(r"[0-9].*[A-Za-z].*[0-9]|[A-Za-z].*[0-9].*[A-Za-z]"), "p"),
        F.when(body.rlike(r"^[A-Za-z]{0,3}[0-9]{1,4}(?:[.,:/-][0-9A-Za-z]{1,4})*[A-Za-z]{0,3}$"), "n"),
        # gazetteers: words for secrets in or just before the token, words that numbers usually follow
        F.when(body.rlike(words_pattern(SECRET_WORDS)) | before.rlike(words_pattern(SECRET_WORDS) + r"[^A-Za-z0-9]{0,3}$"), "p"),
        F.when(before.rlike(words_pattern(PLAIN_WORDS) + r"[\s.,]{1,3}$"), "n"),
        # context: an assignment with a value of some length; a short token
        F.when(body.rlike(r"[=:][^=:]{8,}$"), "p"),
        F.when(F.length(body) < 8, "n")]
    return by_family(m, [F.concat(*(F.coalesce(x, F.lit("a")) for x in of)) for of in (labelers, number, plain, person, place)])


def by_family(m: Column, values: list[Column]) -> Column:
    out = F.when(m.family == MIXED, values[MIXED])
    for k, value in enumerate(values[1:], 1):
        out = out.when(m.family == k, value)
    return out


LABELERS = 7
SHAPES = 6


def shape(m: Column) -> Column:
    """One bit for each feature of the candidate's form and, except for mixed tokens, of what is before it."""
    body = m.body
    count = lambda p: F.length(body) - F.length(F.regexp_replace(body, p, ""))
    bits = [F.length(body) >= 12, F.length(body) >= 18, count("[0-9]") >= 4, body.rlike("[=:]"),
            body.rlike("[0-9][A-Za-z]+[0-9]"), count("[^A-Za-z0-9=:_]") == 0]
    told, marked = m.before.rlike(TOLD + r"[^A-Za-z0-9]{0,2}$"), m.before.rlike(r"(?i)(?:[:=#]|\b(?:is|was|number|no\.?))[^A-Za-z0-9]{0,3}$")
    number = [told, told & marked, body.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), told & (count("[0-9]") >= 4), told & (count("[0-9]") >= 6), body.rlike("[.,/]")]
    plain = [marked, marked & (F.length(body) >= 5), F.length(body) >= 8, body.rlike("[a-z][A-Z]|[^A-Za-z]"), marked & (F.length(body) >= 8), ~marked]
    person = [body.rlike(rf"^{TITLES}\x20"), body.rlike(rf"(?:^|\x20)(?:{'|'.join(GIVEN)})\x20"), m.before.rlike(r"[a-z,:]\x20$"), body.rlike(r"(?:\x20.*){2}"), body.rlike(r"\x20[A-Z][a-z]+$"), body.rlike(rf"\x20(?:{STREETS}|Inc|Ltd|University|College|Company|Bank|Hospital|Airport|River|Bridge)$")]
    place = [body.rlike("^[0-9]{1,4}[A-Za-z]?\\x20"), body.rlike(rf"\x20{STREETS}$"), m.before.rlike(r"(?i)(?:address|lives?|living|at|home|resid\w+)[:,]?\x20$"), body.rlike(r"(?:\x20.*){3}"), F.lit(False), body.rlike("^[0-9]{5,}")]
    return by_family(m, [F.concat(*(F.when(b, "1").otherwise("0") for b in of)) for of in (bits, number, plain, person, place)])


@dataclass
class Model:
    """Weights of the shape bits and, before them, the intercept; `labelers` has what the estimation found of each.

    Both are those of mixed tokens; `others` has the weights of the other families that were seen.
    """
    weights: list[float]
    labelers: list[dict[str, tuple[float, float]]]
    others: dict[int, list[float]] = field(default_factory=dict)

    def personal(self, m: Column) -> Column:
        s = shape(m)
        scores = []
        for weights in (self.weights, *(self.others.get(f, [-1.0] + [0.0] * SHAPES) for f in range(NUMBER, PLACE + 1))):
            score = F.lit(weights[0])
            for k in range(SHAPES):
                score = score + F.when(F.substring(s, k + 1, 1) == "1", F.lit(weights[k + 1])).otherwise(F.lit(0.0))
            scores.append(score > 0)
        return by_family(m, scores)


def estimate(patterns: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], list[dict[str, tuple[float, float]]]]:
    """Expectation-maximisation for labelers that err independently: the likelihood of `personal` for each vote pattern.

    Starts from the majority of votes; a pattern without votes counts as not personal.
    """
    chance = {}
    for p in patterns:
        ayes, noes = p.count("p"), p.count("n")
        chance[p] = 0.02 if not ayes and not noes else (ayes + 0.1) / (ayes + noes + 0.2)
    table: list[dict[str, tuple[float, float]]] = []
    for _ in range(rounds):
        yes = sum(patterns[p] * chance[p] for p in patterns)
        no = sum(patterns[p] * (1 - chance[p]) for p in patterns)
        table = []
        for k in range(LABELERS):
            rates = {}
            for vote in "pna":
                a = sum(patterns[p] * chance[p] for p in patterns if p[k] == vote)
                b = sum(patterns[p] * (1 - chance[p]) for p in patterns if p[k] == vote)
                # a labeler of one opinion keeps it: half a vote of doubt at most
                rates[vote] = ((a + 0.5) / (yes + 1.5), (b + 0.5) / (no + 1.5))
            table.append(rates)
        prior = (yes + 1) / (yes + no + 2)
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[k][p[k]][0] / table[k][p[k]][1]) for k in range(LABELERS))
            chance[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chance, table


def train(shapes: dict[str, tuple[float, float]], rounds: int = 3000, rate: float = 0.5, decay: float = 1e-3) -> list[float]:
    """Logistic regression on counts: for each shape the expected number of personal and of other candidates.

    A tenth as many candidates of the two plainest shapes are added to the others, so that tokens nobody voted on are not
    taken where the corpus has no counterexample.
    """
    total = sum(a + b for a, b in shapes.values()) or 1.0
    weights = [-1.0] + [0.0] * SHAPES
    rows = [([1.0, *(float(x) for x in s)], a / total, b / total) for s, (a, b) in shapes.items()]
    rows += [([1.0, *[0.0] * (SHAPES - 1), x], 0.0, 0.05) for x in (0.0, 1.0)]
    for _ in range(rounds if shapes else 0):
        slope = [decay * w for w in weights]
        for x, a, b in rows:
            y = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * v for w, v in zip(weights, x, strict=True))))))
            for k, v in enumerate(x):
                slope[k] += v * (y * b - (1 - y) * a)
        weights = [w - rate * 4 * g for w, g in zip(weights, slope, strict=True)]
    return weights


def learn(docs: DataFrame, text: str = "text") -> Model:
    """Learn from all candidates of all texts.  Without candidates nothing is called personal."""
    rows = with_spans(docs.select(docs[text].alias("t")), F.col("t"), "base", "tokens")
    found = rows.select(F.explode("tokens").alias("m")).select(F.col("m.family").alias("family"), votes(F.col("m")).alias("votes"), shape(F.col("m")).alias("shape"))
    # at most 3 ** LABELERS * 2 ** SHAPES rows for each family, each a count
    counts = cut(found.groupBy("family", "votes", "shape").agg(F.count("*").alias("c")), "votes")
    patterns: dict[int, dict[str, int]] = {}
    for r in counts.groupBy("family", "votes").agg(F.sum("c")).collect():
        patterns.setdefault(r[0], {})[r[1]] = r[2]
    model = Model([-1.0] + [0.0] * SHAPES, [])
    for family in sorted(patterns):
        chance, table = estimate(patterns[family])
        likely = F.create_map(*(F.lit(x) for p, c in sorted(chance.items()) for x in (p, float(c))))[F.col("votes")]
        own = counts.where(F.col("family") == family)
        shapes = {r[0]: (r[1], r[2]) for r in own.groupBy("shape").agg(F.sum(F.col("c") * likely), F.sum(F.col("c") * (1 - likely))).collect()}
        if family == MIXED:
            model.weights, model.labelers = train(shapes), table
        else:
            model.others[family] = train(shapes)
    return model


def find(docs: DataFrame, model: Model, text: str = "text", into: str = "personal") -> DataFrame:
    """`docs` with one more column, a struct of `base` and `spans`, arrays of (start, rank, end) in code points, end exclusive.

    `spans` has the base spans and the added ones.  A null text is empty and has none.  All rows and columns stay; if `into`
    is taken, underscores are added to it.
    """
    into = free_name(docs, into)
    base, tokens = free_name(docs, f"{into}_base"), free_name(docs, f"{into}_tokens")
    out = with_spans(docs, docs[text], base, tokens)
    added = F.transform(F.filter(F.col(f"`{tokens}`"), model.personal),
                        lambda m: F.struct(m.start.alias("start"), F.get(F.array(*map(F.lit, RANKS)), m.family).alias("rank"), m.end.alias("end")))
    return settled(out, {into: F.struct(F.col(f"`{base}`").alias("base"), F.sort_array(F.concat(F.col(f"`{base}`"), added)).alias("spans"))}).drop(base, tokens)


def listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.rank), s.start.cast("string"), s.end.cast("string"))), ",")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with each span, or run of overlapping ones, replaced by its kind in angle brackets; same columns and rows.

    A null text stays null.
    """
    into = free_name(docs, "personal")
    out = find(docs, model, text, into)
    spans, t = F.col(into)["spans"], F.col(f"`{text}`")
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    last = lambda a: F.get(a, F.size(a) - 1)
    # a span that begins within the one before is joined to it
    apart = F.aggregate(spans, empty, lambda a, s: F.when(
        (F.size(a) > 0) & (s.start < last(a).end),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a).start.alias("start"), last(a).rank.alias("rank"), F.greatest(last(a).end, s.end).alias("end")))))
        .otherwise(F.concat(a, F.array(F.struct(s.start.alias("start"), s.rank.alias("rank"), s.end.alias("end"))))))
    joined = free_name(out, f"{into}_joined")
    out = settled(out, {joined: apart})
    s = F.col(f"`{joined}`")
    kinds = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    end_before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(s, i - 1).end)
    parts = F.transform(s, lambda x, i: F.concat(F.substring(t, (end_before(i) + 1).cast("int"), (x.start - end_before(i)).cast("int")), F.get(kinds, x.rank)))
    tail = F.substring(t, (F.get(s, F.size(s) - 1).end + 1).cast("int"), F.length(t))
    clean = F.when(F.size(s) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(t)
    return out.select(*((clean.alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each fixed kind, the digest of these and all spans."""
    found = find(docs.select("doc_id", "text"), learn(docs))
    base, spans = F.col("personal.base"), F.col("personal.spans")
    number = lambda rank: F.size(F.filter(base, lambda s: s.rank == rank)).cast("long")
    return found.select("doc_id", *(number(r).alias(f"n_{k}") for r, k in enumerate(KINDS[:4])), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))
