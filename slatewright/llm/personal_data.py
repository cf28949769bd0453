"""Personal data in whole texts by weak supervision, in column expressions only.

1. Candidate spans come from the strict patterns and, as kinds of their own, from wide ones: numbers
   grouped or called like phone numbers but without a plus sign, mail addresses in words, account
   numbers, names after a title or cue, long keys. Labelers vote on each: the strict check of its
   kind, a gazetteer (known number ranges, first names, key words, mail hosts), the words before it
   (context) and what it touches.
2. All candidates of the corpus are counted by kind, votes and features. There are at most a
   fixed number of such combinations, whatever the corpus, so the counts may come to the driver.
3. Expectation-maximisation over these counts estimates, per kind, how often it is personal data
   and how reliable each labeler is.
4. A naive Bayes classifier over span features (length, neighbours, variety of characters) is
   trained on the estimated probabilities. A candidate is accepted when labelers and classifier
   together find it likelier than not; strict matches stay whatever the estimate.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the strict patterns. Runs are possessive, which finds the same spans without
# going back over long runs; a mail address can only begin where its run of characters begins.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: long hexadecimal or key-like strings, a kind of this method's own
SECRET = r"(?:(?<![A-Za-z0-9])|\G)(?=[A-Za-z0-9]*[0-9])(?=[A-Za-z0-9]*[A-Za-z])[A-Za-z0-9]{24,}+"

#: wide patterns, as further kinds of this method
_CALLED = r"(?:[Tt]el|[Pp]hone|[Cc]all|[Ff]ax|[Mm]obile|[Hh]andy)[.:]{0,2} {0,2}"
NUMBER = (
    r"(?<![\p{L}0-9_+.,/-])(?<!\+[0-9]{1,3} ?)(?=[(0-9])(?:\(?[0-9]{2,5}\)?(?:[ /-][0-9]{2,8}){1,4}"
    rf"|(?<={_CALLED})[0-9]{{6,15}})(?![\p{{L}}0-9_])"
)
WRITTEN_MAIL = (
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?: ?\(at\) ?| ?\[at\] ?| at )[a-z0-9-]{1,63}"
    r"(?:(?: ?\(dot\) ?| ?\[dot\] ?| dot )[a-z0-9-]{1,63}){1,4}"
)
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora|[Nn]ame|[Nn]ame is|[Dd]ear|[Ss]igned)"
NAME = rf"(?=\p{{Lu}}\p{{Ll}})(?<={_TITLE}[.:]? )\p{{Lu}}\p{{Ll}}{{1,20}}(?: \p{{Lu}}\p{{Ll}}{{1,20}}){{0,2}}"

BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: pattern and the least a text must hold for the pattern to be tried
KINDS = {
    "email": (EMAIL, r"@"),
    "ip": (IP, r"[0-9]\.[0-9]"),
    "card": (CARD, r"[0-9]"),
    "phone": (PHONE, r"\+[0-9]"),
    "secret": (SECRET, r"[A-Za-z0-9]{24}"),
    # where a shorter test would cost more than the pattern, the pattern itself
    "number": (NUMBER, NUMBER),
    "address": (WRITTEN_MAIL, r"(?i)[ (\[]at[ )\]] ?[a-z0-9-]{1,63} ?[ (\[]dot[ )\]]"),
    "account": (ACCOUNT, r"[A-Z]{2}[0-9]{2}"),
    "name": (NAME, NAME),
}
BASE_KINDS = ("email", "ip", "card", "phone")
CHUNK = 128

# fixed values: gazetteers, as patterns on the candidate, and context words before it
KNOWN = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$",
    "ip": r"^(?!0\.|127\.|255\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
    "card": r"^[3-6]",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"(?i)^(?:akia|asia|ghp|sk|pk|xox)|^[0-9a-f]{32,64}$",
    "number": r"^\(?(?:0[1-9][0-9]{1,3}|[2-9][0-9]{2})\)?[ /-]|^[0-9]{7,12}$",
    "address": r"(?i)[ )\]](?:gmail|hotmail|outlook|yahoo|gmx|web|icloud|proton|mail|example)[ (\[]",
    "account": r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    "name": (
        r"^(?:Alice|Andrea|Anna|Anne|Antonio|Carlos|Charles|Claire|Daniel|David|Elena|Emma|Eva|Francois|Hans|Isabel|Jack|James|Jane|"
        r"Jean|John|Jose|Juan|Julia|Karl|Klaus|Laura|Lisa|Louis|Lucia|Luis|Marc|Maria|Marie|Mark|Martin|Mary|Michael|Nicole|Paul|"
        r"Peter|Pierre|Robert|Sarah|Sofia|Sophie|Stefan|Susan|Thomas|William)\b"
    ),
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|kontakt|correo|courriel|mailto|to|from)\W{0,3}$",
    "ip": r"(?i)(?:\bip|address|adresse|host|server|client|peer|login)\W{0,3}$",
    "card": r"(?i)(?:card|visa|amex|mastercard|karte|carte|tarjeta|credit|payment|account|konto)\W{0,3}$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile?|handy|whatsapp|telefono|téléphone)\W{0,3}$",
    "secret": r"(?i)(?:token|secret|passw(?:or)?d|api.?key|key|credential|auth|bearer)\W{0,5}$",
    "number": r"(?i)(?:tel|phone|call|fax|mobile?|handy|whatsapp|telefono|téléphone)\W{0,3}$",
    "address": r"(?i)(?:e-?mail|mail|contact|kontakt|correo|courriel|write|reach|me|us)\W{0,3}$",
    "account": r"(?i)(?:iban|account|konto|compte|cuenta|bank)\W{0,3}$",
    "name": r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?|[Nn]ame is|[Nn]ame:)\.? $",
}
COUNTER_CUES = r"(?i)(?:version|isbn|issn|figure|fig|section|chapter|no|nr|page|order)\W{0,3}$"
BEFORE = 24


def _spans(kind: str, pattern: str, needs: str) -> Column:
    """All matches, leftmost and non-overlapping, and the gaps between them from the same search."""
    some = F.col("text").rlike(needs)
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return F.when(some, F.struct(found.alias("m"), F.split("text", pattern, -1).alias("g"))).alias(kind)


def _zipped(kind: str) -> Column:
    """Gap, match and the gap after it, in order; the last gap has no match."""
    gaps = F.col(kind)["g"]
    return F.arrays_zip(F.col(kind)["m"].alias("m"), gaps.alias("g"), F.slice(gaps, 2, F.greatest(F.lit(0), F.size(gaps) - 1)).alias("a"))


def _placed(kind: str) -> Column:
    """Array of (start, end, match, before, after): lengths of gaps and matches, added up, give the places.

    The sums run over chunks, then within them, so a text with very many matches costs little more
    than its length.
    """
    size = "cast(length(p.g) + length(coalesce(p.m, '')) as bigint)"
    chunks = (
        f"transform(sequence(0, greatest(0, (size({kind}) - 1) div {CHUNK})), c -> slice({kind}, c * {CHUNK} + 1, {CHUNK}))"
    )
    firsts = (
        f"aggregate({chunks}, array(0L), (s, c) -> array_append(s, element_at(s, -1) + aggregate(c, 0L, (t, p) -> t + {size})))"
    )
    within = (
        "aggregate(c, named_struct('at', o, 'out', cast(array() as array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>)), "
        f"(s, p) -> named_struct('at', s.at + {size}, 'out', if(p.m is null, s.out, array_append(s.out, named_struct("
        "'start', s.at + length(p.g), 'end', s.at + length(p.g) + length(p.m), 'match', p.m, "
        f"'before', right(p.g, {BEFORE}), 'after', left(coalesce(p.a, ''), 1))))), s -> s.out)"
    )
    return F.expr(f"if({kind} is null, null, flatten(zip_with({chunks}, slice({firsts}, 1, size({chunks})), (c, o) -> {within})))")


def _strict(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
        "card": F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15),
        "secret": m.rlike(r"^(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})$"),
        "number": F.length(digits).between(7, 12) & m.rlike(r"^(?:\(?0[1-9]|\([2-9][0-9]{2}\)|[2-9][0-9]{2}[ -][0-9]{3}[ -][0-9]{4}$|[0-9]+$)"),
        "address": m.rlike(r"(?i)[ )\]](?:com|org|net|edu|gov|info|de|fr|es|uk|eu|io)$"),
        "account": _checks_out(m),
        "name": m.contains(" "),
    }[kind]


def _checks_out(account: Column) -> Column:
    """The check of account numbers: the first four characters last, letters as 10 to 35, one modulo 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    values = F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10).cast("bigint"))
    add = lambda kept, v: F.pmod(kept * F.when(v > 9, 100).otherwise(10) + v, F.lit(97).cast("bigint"))
    return F.aggregate(F.filter(values, lambda v: v.isNotNull()), F.lit(0).cast("bigint"), add) == 1


def _votes(kind: str, s: Column) -> Column:
    """One character per labeler: 1 for personal data, 0 against, - no vote."""
    context = F.when(s["before"].rlike(CUES[kind]), "1").when(s["before"].rlike(COUNTER_CUES), "0").otherwise("-")
    return F.concat(
        F.when(_strict(kind, s["match"]), "1").otherwise("0"),
        F.when(s["match"].rlike(KNOWN[kind]), "1").otherwise("0"),
        context,
        # digits that carry on beyond the span speak against it
        F.when(s["after"].rlike(r"[\p{L}0-9_]") | s["before"].rlike(r"[\p{L}0-9_]$"), "0").otherwise("-"),
    )


def _features(s: Column) -> Column:
    """Features of the span that no labeler looks at, as a short text."""
    length = F.least(F.length(s["match"]) / 4, F.lit(12)).cast("int").cast("string")
    ahead = F.when(s["before"] == "", "s").when(s["before"].rlike(r"\s$"), "w").when(s["before"].rlike(r"[\"'(=:]$"), "q").otherwise("o")
    behind = F.when(s["after"] == "", "e").when(s["after"].rlike(r"\s"), "w").when(s["after"].rlike(r"[\"').,;]"), "q").otherwise("o")
    variety = F.least(F.size(F.array_distinct(F.split(s["match"], ""))) / 4, F.lit(5)).cast("int").cast("string")
    return F.concat_ws("/", length, ahead, behind, variety)


def candidates(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents' id and text (null as empty) with ``found``: all candidates with kind, place, key and strict."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("id", "text", *[_spans(k, p, n) for k, (p, n) in KINDS.items()])
    rows = rows.select("id", "text", *[F.when(F.col(k).isNotNull(), _zipped(k)).alias(k) for k in KINDS])
    rows = rows.select("id", "text", *[_placed(k).alias(k) for k in KINDS])

    def marked(kind: str) -> Column:
        def one(s: Column) -> Column:
            votes = _votes(kind, s)
            return F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.concat_ws("|", F.lit(kind), votes, _features(s)).alias("key"),
                votes.startswith("1").alias("strict"),
            )

        return F.coalesce(F.transform(kind, one), F.array().cast("array<struct<kind:string,start:bigint,end:bigint,key:string,strict:boolean>>"))

    return rows.select("id", "text", F.concat(*[marked(k) for k in KINDS]).alias("found"))


def reliabilities(counts: dict[tuple[str, str], int], rounds: int = 40) -> tuple[dict, dict]:
    """EM over (kind, votes) counts: the chance of each pattern, and each labeler's vote shares per kind."""
    chance, shares = {}, {}
    for kind in {k for k, _ in counts}:
        rows = [(v, n) for (k, v), n in counts.items() if k == kind]
        p = {v: (0.9 if v[0] == "1" else 0.15) + 0.02 * (v.count("1") - v.count("0")) / len(v) for v, _ in rows}
        share = {}
        for _ in range(rounds):
            total = sum(n for _, n in rows)
            prior = (sum(p[v] * n for v, n in rows) + 1) / (total + 2)
            for j in range(len(rows[0][0])):
                for vote in "10-":
                    for truth in (True, False):
                        weight = sum((p[v] if truth else 1 - p[v]) * n for v, n in rows)
                        own = sum((p[v] if truth else 1 - p[v]) * n for v, n in rows if v[j] == vote)
                        # the strict check starts out trusted: it counts as ten sure examples
                        trust = 10 * (j == 0) * ((vote == "1") == truth) * (vote != "-")
                        share[j, vote, truth] = (own + trust + 0.5) / (weight + 10 * (j == 0) + 1.5)
            for v, _ in rows:
                odds = math.log(prior / (1 - prior)) + sum(math.log(share[j, x, True] / share[j, x, False]) for j, x in enumerate(v))
                p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        chance |= {(kind, v): x for v, x in p.items()}
        shares[kind] = share
    return chance, shares


def accepted_keys(counts: dict[str, int]) -> list[str]:
    """The combinations of kind, votes and features that the final classifier takes as personal data."""
    votes: dict[tuple[str, str], int] = defaultdict(int)
    for key, n in counts.items():
        kind, vote, _ = key.split("|")
        votes[kind, vote] += n
    chance, _ = reliabilities(votes)
    weight: dict[tuple, float] = defaultdict(float)
    for key, n in counts.items():
        kind, vote, features = key.split("|")
        p = chance[kind, vote]
        for place, value in [("", ""), *enumerate(features.split("/"))]:
            weight[kind, place, value, True] += n * p
            weight[kind, place, value, False] += n * (1 - p)
    out = []
    for key in counts:
        kind, vote, features = key.split("|")
        p = min(max(chance[kind, vote], 1e-6), 1 - 1e-6)
        odds = math.log(p / (1 - p))
        for place, value in enumerate(features.split("/")):
            yes = (weight[kind, place, value, True] + 1) / (weight[kind, "", "", True] + 10)
            no = (weight[kind, place, value, False] + 1) / (weight[kind, "", "", False] + 10)
            odds += math.log(yes / no)
        if odds > 0:
            out.append(key)
    return sorted(out)


def personal_spans(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """id, text, base and extra: arrays of (kind, start, end), base in order of kind and start.

    base: strict matches of the four base kinds. extra: what the method adds. Null counts as
    empty, and an empty text has no spans. Repeated rows have the same spans. Places are code
    points, the end exclusive.
    """
    rows = candidates(docs, id_column)
    # the outer form adds no emptiness test, which would search every text a second time
    tally = rows.select(F.explode_outer("found.key").alias("key")).groupBy("key").count().collect()
    keys = accepted_keys({r["key"]: r["count"] for r in tally if r["key"] is not None})
    # looked up by hash, in a map of as many entries as combinations were accepted
    accepted = F.create_map(*[F.lit(x) for k in keys for x in (k, True)]) if keys else F.create_map().cast("map<string,boolean>")
    is_base = lambda s: s["strict"] & s["kind"].isin(*BASE_KINDS)
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return rows.select(
        "id",
        "text",
        F.transform(F.filter("found", is_base), plain).alias("base"),
        F.transform(F.filter("found", lambda s: ~is_base(s) & F.coalesce(F.try_element_at(accepted, s["key"]), F.lit(False))), plain).alias("extra"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def span_digest(found: DataFrame) -> DataFrame:
    """id, n_<kind> of the base kinds, base_sha256 and spans of the result of ``personal_spans``."""
    of_kind = [_of_kind(F.concat("base", "extra"), k) for k in KINDS]
    by_start = [F.array_sort(F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))) for a in of_kind]
    return found.select(
        "id",
        *[F.size(_of_kind("base", k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat(*by_start)).alias("spans"),
    )


def redacted(found: DataFrame) -> DataFrame:
    """id and text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    ordered = found.withColumn("all", F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    pieces = F.expr(
        "aggregate(all, named_struct('at', 0L, 'out', cast(array() as array<string>)), (s, x) -> if(x.end <= s.at, s, named_struct("
        "'at', x.end, 'out', array_append(s.out, if(x.start < s.at, '', concat(substring(text, cast(s.at as int) + 1, cast(x.start - s.at as int)), "
        "'<', upper(x.kind), '>'))))), s -> concat(array_join(s.out, ''), substring(text, cast(s.at as int) + 1)))"
    )
    return ordered.select("id", F.when(F.size("all") > 0, pieces).otherwise(F.col("text")).alias("text"))
