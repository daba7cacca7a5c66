"""License scan: ordered signature rules over words, native Spark only.

A text is lower-cased (A-Z) and read as words: runs of letters outside ASCII, digits and a-z. A signature is a regular
expression over words around an anchor keyword. Three gates keep the work small: the document must hold an
anchor keyword at all; only the words around each anchor are looked at; and a rule
runs only where its anchor stands and its required word is near. Rules have a priority (1 full title or identifier,
2 named licence, 3 mention). Detections are ordered by start, longest first; one whose words lie within those of another
of the same or a better priority is suppressed, in one pass with running interval ends.

The base phrases (see ``BASE``) are rules of priority 0: they are counted wherever their words
stand consecutively and nothing suppresses them.

Defined results: a null or empty text, or one without words, has n_words 0, no detection, null first_word and
last_word, empty labels, score 0. Repeated rows and null ids are scanned like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SEPARATORS, ascii_lower, text_or_empty

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Words looked at before and after an anchor.
BEFORE, AFTER = 12, 14
#: Marks the anchor inside its context; never part of a word.
MARK = "\x01"

_LICENSE = "(?:license|licence)"


def _families() -> list[tuple[str, str, list[str]]]:
    """label, pattern of its name in words, versions as word patterns."""
    return [
        ("mit", "mit", []), ("mit-0", "mit 0", []), ("x11", "x11", []), ("expat", "expat", []), ("isc", "isc", []),
        ("apache", "apache(?: software)?", ["1 0", "1 1", "2 0", "2"]),
        ("gpl", "gnu general public|gnu gpl|gpl", ["1", "2", "2 0", "2 1", "3", "3 0"]),
        ("lgpl", "(?:gnu )?(?:lesser|library) general public|lgpl", ["2", "2 0", "2 1", "3", "3 0"]),
        ("agpl", "(?:gnu )?affero general public|agpl", ["1", "3", "3 0"]),
        ("gfdl", "gnu free documentation|gfdl", ["1 1", "1 2", "1 3"]),
        ("bsd", "(?:[234] clause |new |modified |simplified |original |revised )?bsd(?: [234] clause)?", []),
        ("0bsd", "zero clause bsd|0bsd", []),
        ("mpl", "mozilla public|mpl", ["1 0", "1 1", "2 0", "2"]),
        ("epl", "eclipse public|epl", ["1 0", "2 0"]), ("edl", "eclipse distribution|edl", ["1 0"]),
        ("cddl", "common development and distribution|cddl", ["1 0", "1 1"]),
        ("cpl", "common public|cpl", ["1 0"]), ("ipl", "ibm public|ipl", ["1 0"]),
        ("eupl", "european union public|eupl", ["1 0", "1 1", "1 2"]),
        ("cecill", "cecill(?: [bc])?", ["1 0", "1 1", "2 0", "2 1"]),
        ("artistic", "artistic", ["1 0", "2 0"]), ("zlib", "zlib(?: libpng)?", []), ("libpng", "libpng", ["2", "2 0"]),
        ("boost", "boost software|bsl", ["1 0", "1"]), ("unlicense", "the unlicense", []), ("wtfpl", "do what the fuck you want to public|wtfpl", ["1", "2"]),
        ("cc0", "cc0|creative commons zero", ["1 0"]),
        ("cc-by", "cc by|creative commons attribution", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
        ("cc-by-sa", "cc by sa|creative commons attribution share ?alike", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
        ("cc-by-nc", "cc by nc|creative commons attribution non ?commercial", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
        ("cc-by-nd", "cc by nd|creative commons attribution no ?deriv(?:ative)?s", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
        ("cc-by-nc-sa", "cc by nc sa", ["2 0", "2 5", "3 0", "4 0"]), ("cc-by-nc-nd", "cc by nc nd", ["2 0", "2 5", "3 0", "4 0"]),
        ("odbl", "open database|odbl", ["1 0"]), ("odc-by", "open data commons attribution|odc by", ["1 0"]), ("pddl", "public domain dedication|pddl", ["1 0"]),
        ("ofl", "sil open font|open font|ofl", ["1 0", "1 1"]), ("ms-pl", "microsoft public|ms pl", []), ("ms-rl", "microsoft reciprocal|ms rl", []),
        ("python", "python software foundation|psf|python", ["2", "2 0"]), ("php", "php", ["3 0", "3 01"]), ("ruby", "ruby", []),
        ("openssl", "openssl", []), ("postgresql", "postgresql", []), ("ntp", "ntp", []), ("ncsa", "university of illinois ncsa|ncsa", []),
        ("osl", "open software|osl", ["1 0", "2 0", "2 1", "3 0"]), ("afl", "academic free|afl", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
        ("qpl", "q public|qpl", ["1 0"]), ("apsl", "apple public source|apsl", ["1 0", "1 1", "1 2", "2 0"]), ("npl", "netscape public|npl", ["1 0", "1 1"]),
        ("lppl", "latex project public|lppl", ["1 0", "1 1", "1 2", "1 3"]), ("w3c", "w3c(?: software)?", []), ("vim", "vim", []), ("sleepycat", "sleepycat", []),
        ("upl", "universal permissive|upl", ["1 0"]), ("rpl", "reciprocal public|rpl", ["1 1", "1 5"]), ("sspl", "server side public|sspl", ["1", "1 0"]),
        ("busl", "business source|busl", ["1 0", "1 1"]), ("elastic", "elastic", ["1", "2", "2 0"]), ("bigscience", "bigscience (?:open )?rail|openrail", ["1 0"]),
        ("llama", "llama [234](?: [123])? community", []), ("fair", "fair", []), ("beerware", "beerware|beer ware", []), ("json", "json", []),
        ("hippocratic", "hippocratic", ["2 0", "2 1", "3 0"]), ("mulan", "mulan (?:psl|permissive software)", ["1", "2"]), ("blueoak", "blue oak model", ["1 0 0"]),
    ]


def rules() -> list[tuple[str, str, str, int, str]]:
    """(anchor, required word or '', regex, priority, label), ordered; the regex sees words parted by blanks with MARK before the anchor."""
    out = []
    for label, name, versions in _families():
        names = f"(?:{name})"
        need = "" if any(c in name for c in "|(?[") else name.split(" ")[-1]
        version = f"(?: version| v)? (?:v ?)?(?:{'|'.join(sorted(versions, key=len, reverse=True))})" if versions else ""
        for anchor in ("license", "licence"):
            title = f"(?:^| ){names} {MARK}{anchor}"
            if versions:
                out.append((anchor, need, f"{title}{version}(?= |$)", 1, label))
            out.append((anchor, need, f"{title}(?= |$)", 2, label))
            out.append((anchor, need, f"(?:^| ){MARK}{anchor} (?:type |id |name |is |under |identifier )?(?:the )?{names}(?= |$)", 3, label))
        out.append(("licensed", need, f"(?:^| ){MARK}licensed under (?:the )?(?:terms of )?(?:the )?{names}(?= |$)", 2, label))
        out.append(("spdx", need, f"(?:^| ){MARK}spdx {_LICENSE} identifier {names}(?: |$)", 1, label))
        out.append(("released", need, f"(?:^| ){MARK}released under (?:the )?(?:terms of )?(?:the )?{names}(?= |$)", 2, label))
        out.append(("terms", need, f"(?:^| ){MARK}terms of (?:the )?{names}(?= |$)", 3, label))
    for anchor, regex, priority, label in (
            ("copyright", f"{MARK}copyright (?:c )?(?:19|20)[0-9][0-9](?= |$)", 2, "copyright"),
            ("copyright", f"{MARK}copyright (?:c )?by(?= |$)", 3, "copyright"),
            ("rights", f"all {MARK}rights reserved(?= |$)", 2, "all-rights-reserved"),
            ("rights", f"some {MARK}rights reserved(?= |$)", 3, "some-rights-reserved"),
            ("domain", f"(?:placed )?(?:in|into|to) the public {MARK}domain(?= |$)", 2, "public-domain"),
            ("domain", f"public {MARK}domain(?= |$)", 3, "public-domain"),
            ("warranty", f"without {MARK}warranty of any kind(?= |$)", 3, "no-warranty"),
            ("warranties", f"without {MARK}warranties or conditions of any kind(?= |$)", 3, "no-warranty"),
            ("hereby", f"permission is {MARK}hereby granted free of charge(?= |$)", 2, "mit"),
            ("redistribution", f"{MARK}redistribution and use in source and binary forms(?= |$)", 2, "bsd"),
            ("proprietary", f"{MARK}proprietary and confidential(?= |$)", 2, "proprietary"),
            ("commercial", f"non {MARK}commercial use only(?= |$)", 3, "non-commercial"),
            ("redistribute", f"you can {MARK}redistribute it and or modify it under the terms(?= |$)", 2, "gpl")):
        out.append((anchor, "", f"(?:^| ){regex}", priority, label))
    return out


def _by_anchor() -> Column:
    """map<anchor, array<struct<need, regex, priority, label>>> as a literal."""
    grouped: dict[str, list[Column]] = {}
    for anchor, need, regex, priority, label in rules():
        grouped.setdefault(anchor, []).append(F.struct(F.lit(need).alias("need"), F.lit(regex).alias("regex"), F.lit(priority).alias("priority"), F.lit(label).alias("label")))
    return F.create_map(*[x for a, r in grouped.items() for x in (F.lit(a), F.array(*r))])


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _detections(words: Column) -> Column:
    """For each anchor word, in order, array<struct<start, end, priority, label>>, end exclusive, of all rules but the base ones."""
    anchors = sorted({r[0] for r in rules()})
    at = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda x: x["w"].isin(anchors))

    def around(x: Column) -> Column:
        left = F.slice(words, F.greatest(x["i"] + 1 - BEFORE, F.lit(1)), F.least(x["i"], F.lit(BEFORE)))
        right = F.slice(words, x["i"] + 1, F.lit(AFTER + 1))
        lead = F.array_join(left, " ")
        return F.struct(x["i"].alias("i"), x["w"].alias("w"), F.concat(lead, F.when(F.length(lead) > 0, " ").otherwise(""), F.lit(MARK), F.array_join(right, " ")).alias("near"))

    def found(o: Column) -> Column:
        fit = F.filter(F.coalesce(F.try_element_at(_by_anchor(), o["w"]), F.array().cast("array<struct<need:string,regex:string,priority:int,label:string>>")),
                       lambda r: F.contains(o["near"], r["need"]) & F.regexp_like(o["near"], r["regex"]))

        def span(r: Column) -> Column:
            hit = F.trim(F.regexp_substr(o["near"], r["regex"]))
            start = o["i"] - _blanks(F.substring_index(hit, MARK, 1))
            return F.struct(start.cast("int").alias("start"), (start + _blanks(hit) + 1).cast("int").alias("end"), r["priority"].alias("priority"), r["label"].alias("label"))

        return F.transform(fit, span)

    return F.transform(F.transform(at, around), found)


def _surviving(found: Column) -> Column:
    """Detections that no other contains with at least its priority (of equal ones the first label), sorted, each once. A span lies within BEFORE and AFTER words of
    its anchor, so only those of so many anchors around can contain it: the work is linear in the anchors."""
    reach = BEFORE + AFTER

    def beats(e: Column, d: Column) -> Column:
        same = (e["start"] == d["start"]) & (e["end"] == d["end"]) & (e["priority"] == d["priority"])
        around = (e["start"] <= d["start"]) & (d["end"] <= e["end"]) & (e["priority"] <= d["priority"])
        return around & (~same | (e["label"] < d["label"]))

    def kept(all_: Column) -> Column:
        def at(own: Column, k: Column) -> Column:
            near = F.when(F.size(own) > 0, F.flatten(F.slice(all_, F.greatest(k - reach + 1, F.lit(1)), F.lit(2 * reach + 1))))
            return F.transform(F.array(near), lambda n: F.filter(own, lambda d: ~F.exists(n, lambda e: beats(e, d))))[0]
        return F.sort_array(F.flatten(F.transform(all_, at)))

    once = lambda x: F.filter(x, lambda d, i: (i == 0) | (d != F.get(x, i - 1)))
    # one-element arrays bind what is named several times
    return F.transform(F.transform(F.array(found), kept), once)[0]


def _base(words: Column) -> Column:
    """array<struct<start, label>> of every place of a base phrase."""
    return F.concat(*[_places(words, phrase.split(" "), label) for phrase, label in BASE.items()])


def _places(words: Column, parts: list[str], label: str) -> Column:
    def spot(w: Column, i: Column) -> Column:
        fits = (w == parts[0]) & _all([F.get(words, i + k) == p for k, p in enumerate(parts) if k])
        return F.when(fits, F.struct(i.cast("bigint").alias("start"), F.lit(label).alias("label")))

    return F.filter(F.transform(words, spot), lambda x: x.isNotNull())


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def scan(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: carried columns, n_words, base (spots), detections (surviving spans), labels, score."""
    flat = F.trim(F.regexp_replace(ascii_lower(text_or_empty(F.col(text_col))), ASCII_SEPARATORS, " "))
    rows = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)], flat.alias("__flat"))
    anchors = sorted({r[0] for r in rules()})
    gate = F.regexp_like(F.col("__flat"), F.lit(r"(?:^| )(?:" + "|".join(anchors) + r")(?: |$)"))
    gated = rows.withColumn("n_words", F.when(F.col("__flat") == "", F.lit(0)).otherwise(_blanks(F.col("__flat")) + 1).cast("bigint"))
    gated = gated.withColumn("__words", F.when(gate, F.split("__flat", " "))).drop("__flat")
    spot, det = "array<struct<start:bigint,label:string>>", "array<struct<start:int,end:int,priority:int,label:string>>"
    words = F.col("__words")
    scanned = (gated.withColumn("base", F.coalesce(F.when(words.isNotNull(), _base(words)), F.array().cast(spot)))
               .withColumn("detections", F.coalesce(F.when(words.isNotNull(), _surviving(_detections(words))), F.array().cast(det))).drop("__words"))
    covered = F.aggregate("detections", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), lambda acc, d: F.struct(
        F.greatest(acc["upto"], d["end"]).alias("upto"), (acc["n"] + F.greatest(d["end"] - F.greatest(acc["upto"], d["start"]), F.lit(0))).alias("n")), lambda acc: acc["n"])
    labels = F.array_sort(F.array_union(F.transform("base", lambda b: b["label"]), F.transform("detections", lambda d: d["label"])))
    score = F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.greatest(covered, F.size("base")) / F.col("n_words"))).otherwise(F.lit(0.0))
    return scanned.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], "n_words", "base", "detections", labels.alias("labels"), score.cast("double").alias("score"))
