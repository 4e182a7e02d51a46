"""Establishment matching across two systems, without comparing all pairs.

Score = weighted sum of four dimensions, each in 0..1:

* name: the best of the edit-distance ratio of the names written without blanks (so
  "Bellavista" and "Bella Vista" agree), the share of common words, and the share of common
  phonetic codes (Soundex of each word). Names are lower case, punctuation becomes a blank,
  abbreviations are written out (:data:`ABBREVIATIONS`) and company forms are dropped.
* address: mean of zip equality, street-number equality, and the edit-distance ratios of
  street and city.
* contact: 1 when the mail address, the phone number or the website is the same, 0.5 when
  only the mail domain is.
* legal: 1 when the legal id is the same.

Pairs below ``threshold`` are not results. Candidates come from joins on keys, never from a
block of all pairs: for every set S of exact fields (zip, number, strong contact, mail
domain, legal id) that a pair can have equal, the weights give the least name score that
pair needs, ``t(S)``. Its keys combine the values of S with name keys for ``t(S)``:

* the edit ratio reaches t only if one of the tau + 1 segments of the longer name (tau =
  floor((1 - t) * length)) stands in the shorter one within tau places (the partition
  filter of edit-distance joins);
* a share t of common words or codes needs one of the first ``n - o + 1`` of them when
  they are sorted from rare to frequent (the prefix filter of set-similarity joins).

Where ``t(S)`` is below :data:`LEAST_NAME` the values of S alone are the key; S is then at
least two fields or holds a strong one. They are also the key alone where so few profiles
share them that comparing all of these is cheaper (:data:`PAIRS_PER_ROW`). Every result
shares a key of its own S, so none is lost; weights that would need a key without any field
and a loose name are refused.

Copies are matched once: both sides are first reduced to distinct normalised profiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_of
from tidemark.session import checkpointed

# Weights of the four dimensions and the score below which a pair is dropped.
WEIGHTS = {"name": 0.40, "address": 0.30, "contact": 0.20, "legal": 0.10}
THRESHOLD = 0.60

# Words that only say what kind of company it is, and abbreviations written out.
COMPANY_FORMS = ("gmbh", "ag", "kg", "ltd", "inc", "llc", "sarl", "sas", "srl", "spa", "bv", "the")
ABBREVIATIONS = {
    "co": "company", "corp": "corporation", "intl": "international", "bros": "brothers", "mfg": "manufacturing",
    "rest": "restaurant", "ctr": "center", "svc": "service", "assoc": "associates", "dept": "department",
    "univ": "university", "natl": "national", "mgmt": "management", "tech": "technology", "st": "saint", "mt": "mount",
}
STREET_ABBREVIATIONS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "blvd": "boulevard", "pl": "place", "sq": "square",
    "ln": "lane", "dr": "drive",
}

#: Below this least name score a key is the equal fields alone (name keys would match nearly anything).
LEAST_NAME = 0.6
SLACK = 1e-5  # scores are rounded to 6 places
#: A block with at most this many pairs per profile is compared whole: fewer rows than its name keys.
PAIRS_PER_ROW = 12

FIELDS = ("name", "zip", "city", "street", "email", "phone", "website", "legal_id")
PROFILE = ("iso_code", "name", "zip", "city", "street", "street_no", "email", "domain", "phone", "website", "legal_id")


def plain(col: Column | str) -> Column:
    """Lower case, punctuation to blanks, single blanks; empty gives null."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.regexp_replace(F.regexp_replace(F.lower(col), "&", " and "), r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(text), F.lit(""))


def _written_out(col: Column, abbreviations: Mapping[str, str] = ABBREVIATIONS) -> Column:
    """Abbreviated words of a plain name or street written out."""
    table = F.create_map(*[F.lit(x) for pair in abbreviations.items() for x in pair])
    parts = F.transform(F.split(col, " "), lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.nullif(F.array_join(parts, " "), F.lit(""))


def _name_words(col: Column) -> Column:
    """Words of a normalised name in order, without company forms."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), " "), lambda w: (w != "") & ~w.isin(*COMPANY_FORMS))


def words(col: Column) -> Column:
    """Distinct words of a normalised name without company forms."""
    return F.array_distinct(_name_words(col))


def compact(col: Column) -> Column:
    """The name's words without blanks; null where there are none."""
    return F.nullif(F.array_join(_name_words(col), ""), F.lit(""))


def codes(col: Column) -> Column:
    """Distinct Soundex codes of the name's words."""
    return F.array_distinct(F.transform(words(col), lambda w: F.soundex(w)))


def street_number(col: Column) -> Column:
    """First number in an address line ("123A" and "123-125" give 123)."""
    return F.nullif(F.regexp_extract(F.coalesce(col, F.lit("")), r"(\d+)", 1), F.lit(""))


def normalise(df: DataFrame) -> DataFrame:
    """Comparable form of the establishment columns ``iso_code`` and :data:`FIELDS`."""
    street = _written_out(plain("street"), STREET_ABBREVIATIONS)
    host = F.regexp_replace(F.lower(F.col("website")), r"^(https?://)?(www\.)?|/.*$", "")
    email = F.nullif(F.trim(F.lower("email")), F.lit(""))
    return df.select(
        "id",
        F.upper("iso_code").alias("iso_code"),
        _written_out(plain("name")).alias("name"),
        F.nullif(F.regexp_replace(F.upper("zip"), r"[^0-9A-Z]", ""), F.lit("")).alias("zip"),
        plain("city").alias("city"),
        F.nullif(F.trim(F.regexp_replace(street, r"\d+\s*[a-z]?\b", "")), F.lit("")).alias("street"),
        street_number(street).alias("street_no"),
        email.alias("email"),
        F.nullif(F.regexp_extract(email, r"@(.+)$", 1), F.lit("")).alias("domain"),
        F.nullif(F.regexp_replace("phone", r"^(\+|00)|[^0-9]", ""), F.lit("")).alias("phone"),
        F.nullif(host, F.lit("")).alias("website"),
        F.nullif(F.regexp_replace(F.upper("legal_id"), r"[^0-9A-Z]", ""), F.lit("")).alias("legal_id"),
    )


def profiles(df: DataFrame) -> DataFrame:
    """Distinct normalised establishments: ``profile_id``, smallest member id, member count."""
    plain_rows = normalise(df)
    keyed = plain_rows.withColumn("profile_id", hash_of(plain_rows, PROFILE))
    return keyed.groupBy("profile_id", *PROFILE).agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("members")
    )


def members(df: DataFrame) -> DataFrame:
    """Which record belongs to which profile; expands matches back to records."""
    plain_rows = normalise(df)
    return plain_rows.select("id", hash_of(plain_rows, PROFILE).alias("profile_id"))


#: Exact fields a pair can share; "c" is any strong contact (mail address, phone, website).
EXACT = ("z", "n", "c", "d", "l")


def least_names(weights: Mapping[str, float], threshold: float) -> dict[frozenset, float]:
    """For each set of equal exact fields that can reach ``threshold``: the least name score it needs.

    Raises where a pair with no equal field and a name score below :data:`LEAST_NAME` could
    reach the threshold, as no key could find it.
    """
    out = {}
    for mask in range(1 << len(EXACT)):
        fields = frozenset(f for k, f in enumerate(EXACT) if mask >> k & 1)
        if {"c", "d"} <= fields:
            continue  # an equal mail address has an equal domain: the set without "d" needs the same
        address = (("z" in fields) + ("n" in fields) + 2) / 4
        contact = 1.0 if "c" in fields else 0.5 if "d" in fields else 0.0
        legal = 1.0 if "l" in fields else 0.0
        rest = weights["address"] * address + weights["contact"] * contact + weights["legal"] * legal
        need = (threshold - rest) / weights["name"] - SLACK
        if need > 1:
            continue
        if not fields and need < LEAST_NAME:
            raise ValueError("a result could share no field and have a loose name: no key can find it")
        out[fields] = max(need, 0.0)
    return out


def _rare(column: str, share: Column, side: str) -> Column:
    """Hashes of the rare items of sorted array ``column``, one prefix per size a partner can have.

    Both sizes are part of the hash, in the order (first source, second source).
    """
    n = F.size(column)
    least = F.ceil(n * share - F.lit(1e-9)).cast("int")
    most = F.floor(n / share + F.lit(1e-9)).cast("int")

    def prefix(m: Column) -> Column:
        common = F.ceil((n + m) * (share / (share + 1)) - F.lit(1e-9)).cast("int")
        first, second = (n, m) if side == "a" else (m, n)
        return F.transform(
            F.slice(column, 1, F.greatest(n - common + 1, F.lit(0))),
            lambda w: F.xxhash64(F.lit(column), w, first, second),
        )

    return F.when(n > 0, F.flatten(F.transform(F.sequence(least, most), prefix))).otherwise(
        F.array().cast("array<bigint>")
    )


def _span(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def _segments(length: Column, t: Column) -> tuple[Column, Column, Column, Column]:
    """tau, and for segment ``i``: functions of start (from 0) and length, of the even partition in tau + 1."""
    tau = F.floor(length * (F.lit(1.0) - t) + F.lit(1e-9)).cast("int")
    k = tau + 1
    base = F.floor(length / k).cast("int")
    short = k - (length - base * k)  # segments of length base; the rest have base + 1
    return tau, k, base, short


def _edit_keys(t: Column, own: str, other: str) -> Column:
    """Partition-filter keys of the compact name: own segments tagged ``own``, probes for longer partners ``other``."""
    s = F.col("compact")
    length = F.coalesce(F.length(s), F.lit(0))
    tau, k, base, short = _segments(length, t)

    def start(i, b, sh):
        return i * b + F.greatest(F.lit(0), i - sh)

    def size(i, b, sh):
        return b + F.when(i >= sh, 1).otherwise(0)

    mine = F.transform(
        _span(F.lit(0), k - 1),
        lambda i: F.xxhash64(F.lit(own), length, i, F.substring(s, start(i, base, short) + 1, size(i, base, short))),
    )

    def probes(longer: Column) -> Column:
        tau2, k2, base2, short2 = _segments(longer, t)

        def at(i):
            first = start(i, base2, short2)
            width = size(i, base2, short2)
            places = _span(F.greatest(F.lit(0), first - tau2), F.least(length - width, first + tau2))
            return F.transform(places, lambda p: F.xxhash64(F.lit(other), longer, i, F.substring(s, p + 1, width)))

        return F.when(longer - length <= tau2, F.flatten(F.transform(_span(F.lit(0), k2 - 1), at))).otherwise(
            F.array().cast("array<bigint>")
        )

    theirs = F.flatten(F.transform(_span(length, F.floor(length / t + F.lit(1e-9)).cast("int")), probes))
    return F.when(length > 0, F.concat(mine, theirs)).otherwise(F.array().cast("array<bigint>"))


def _blocks(df: DataFrame, needs: Mapping[frozenset, float]) -> DataFrame:
    """A profile's blocks: for each set of equal fields its values (``block``) and the name score they need."""
    values = {"z": F.col("zip"), "n": F.col("street_no"), "d": F.col("domain"), "l": F.col("legal_id")}
    strong = {"e": F.col("email"), "p": F.col("phone"), "w": F.col("website")}
    blocks = []
    for fields, t in needs.items():
        tag = "".join(sorted(fields)) + f"|{t:.6f}"
        plain_fields = [values[f] for f in sorted(fields) if f != "c"]
        variants = [(c, v) for c, v in strong.items()] if "c" in fields else [("", None)]
        for kind, value in variants:
            cols = plain_fields + ([value] if value is not None else [])
            present = F.lit(True)
            for c in cols:
                present = present & c.isNotNull()
            block = F.xxhash64(F.lit(tag + kind), F.col("iso_code"), *cols)
            blocks.append(F.when(present, F.struct(F.lit(t).alias("need"), block.alias("block"))))
    return df.select("profile_id", "name", F.inline(F.array_compact(F.array(*blocks))))


def _name_keys(named: DataFrame, frequent: Column, side: str) -> DataFrame:
    """``named`` (``block``, ``need``, ``name``) with the name keys for the needed score, one a row.

    A hash collision only adds a candidate. Words and codes are sorted from rare to frequent.
    The score is a column, so the expression stands in the plan once and not once per score.
    """
    def by_rarity(items: Column, tag: str) -> Column:
        ordered = F.array_sort(
            F.transform(
                items,
                lambda w: F.struct(
                    F.coalesce(F.try_element_at("_frequent", F.concat(F.lit(tag), w)), F.lit(0)).alias("f"), w.alias("w")
                ),
            )
        )
        return F.transform(ordered, lambda x: x["w"])

    t = F.col("need")
    own, other = ("a", "b") if side == "a" else ("b", "a")
    sorted_names = named.withColumn("_frequent", frequent).select(
        "block", "need", "name",
        by_rarity(words(F.col("name")), "w:").alias("sorted_words"),
        by_rarity(codes(F.col("name")), "c:").alias("sorted_codes"),
        compact(F.col("name")).alias("compact"),
    )
    keys = F.concat(_rare("sorted_words", t, side), _rare("sorted_codes", t, side), _edit_keys(t, own, other))
    return sorted_names.select("block", "name", F.explode(F.array_distinct(keys)).alias("name_key"))


def frequent_words(*sides: DataFrame, least_share: float = 1e-3) -> DataFrame:
    """Words ("w:" + word) and codes ("c:" + code) that make up at least ``least_share`` of their kind.

    At most ``2 / least_share`` rows, whatever the size of the input.
    """
    counted = None
    for s in sides:
        one = s.select(F.explode(F.concat(
            F.transform(words(F.col("name")), lambda w: F.concat(F.lit("w:"), w)),
            F.transform(codes(F.col("name")), lambda w: F.concat(F.lit("c:"), w)),
        )).alias("w"))
        counted = one if counted is None else counted.unionByName(one)
    counted = counted.groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.substring("w", 1, 2))
    totals = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    return counted.join(totals, "kind").where(F.col("n") >= F.col("total") * F.lit(least_share)).select("w", "n")


def candidate_pairs(
    a: DataFrame, b: DataFrame, weights: Mapping[str, float] = WEIGHTS, threshold: float = THRESHOLD
) -> DataFrame:
    """Distinct pairs of profile ids that can reach ``threshold``; a superset of all results."""
    needs = least_names(weights, threshold)
    frequent = frequent_words(a, b).agg(
        F.map_from_entries(F.collect_list(F.struct("w", "n"))).alias("m")
    ).scalar()
    blocks_a, blocks_b = _blocks(a, needs), _blocks(b, needs)
    sizes = _shuffled_join(
        blocks_a.groupBy("block").agg(F.first("need").alias("need"), F.count(F.lit(1)).alias("n_a")),
        blocks_b.groupBy("block").agg(F.count(F.lit(1)).alias("n_b")),
        ["block"],
    )
    whole = (F.col("need") < LEAST_NAME) | (F.col("n_a") * F.col("n_b") <= PAIRS_PER_ROW * (F.col("n_a") + F.col("n_b")))
    sizes = checkpointed(sizes.select("block", whole.alias("whole")))
    ids_a = blocks_a.withColumnRenamed("profile_id", "profile_a")
    ids_b = blocks_b.withColumnRenamed("profile_id", "profile_b")

    in_whole = _shuffled_join(ids_a, sizes.where("whole"), ["block"])
    pairs = _shuffled_join(in_whole.select("block", "profile_a"), ids_b.select("block", "profile_b"), ["block"])

    # A name that many profiles of a block carry gets its keys, and its partners, once.
    keyed = sizes.where(~F.col("whole")).select("block")
    in_a, in_b = _shuffled_join(ids_a, keyed, ["block"]), _shuffled_join(ids_b, keyed, ["block"])
    keys_a = _name_keys(in_a.select("block", "need", "name").distinct(), frequent, "a").withColumnRenamed("name", "name_a")
    keys_b = _name_keys(in_b.select("block", "need", "name").distinct(), frequent, "b").withColumnRenamed("name", "name_b")
    names = _shuffled_join(keys_a, keys_b, ["block", "name_key"]).select("block", "name_a", "name_b").distinct()
    found = _shuffled_join(names, in_a.select("block", F.col("name").alias("name_a"), "profile_a"), ["block", "name_a"])
    found = _shuffled_join(found, in_b.select("block", F.col("name").alias("name_b"), "profile_b"), ["block", "name_b"])
    return pairs.select("profile_a", "profile_b").unionByName(found.select("profile_a", "profile_b")).distinct()


def _shuffled_join(x: DataFrame, y: DataFrame, on: Sequence[str]) -> DataFrame:
    """An inner join that is never broadcast: both sides are many times the profiles they come from,
    which the planner's size estimate does not see, and a broadcast passes through the driver."""
    return x.hint("merge").join(y.hint("merge"), list(on))


def _ratio(x: Column, y: Column) -> Column:
    """Edit-distance ratio in 0..1; missing text gives 0."""
    longest = F.greatest(F.length(x), F.length(y))
    return F.coalesce(F.lit(1.0) - F.levenshtein(x, y) / longest, F.lit(0.0))


def _same(x: Column, y: Column) -> Column:
    return F.when(x == y, F.lit(1.0)).otherwise(F.lit(0.0))


def _jaccard(x: Column, y: Column) -> Column:
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def field_scores(pairs: DataFrame) -> DataFrame:
    """Score columns of joined profiles (``a_*`` and ``b_*``)."""
    def a(c: str) -> Column:
        return F.col(f"a_{c}")

    def b(c: str) -> Column:
        return F.col(f"b_{c}")

    one = pairs.withColumns(
        {
            "fm_words": _jaccard(words(a("name")), words(b("name"))),
            "fm_edit": _ratio(compact(a("name")), compact(b("name"))),
            "fm_phonetic": _jaccard(codes(a("name")), codes(b("name"))),
            "fm_mean_zip": _same(a("zip"), b("zip")),
            "fm_mean_street_no": _same(a("street_no"), b("street_no")),
            "fm_mean_street": _ratio(a("street"), b("street")),
            "fm_mean_city": _ratio(a("city"), b("city")),
            "fm_mean_email": _same(a("email"), b("email")),
            "fm_mean_domain": _same(a("domain"), b("domain")),
            "fm_mean_phone": _same(a("phone"), b("phone")),
            "fm_mean_website": _same(a("website"), b("website")),
            "fm_mean_legal_id": _same(a("legal_id"), b("legal_id")),
        }
    )
    parts = ("fm_mean_zip", "fm_mean_street_no", "fm_mean_street", "fm_mean_city")
    return one.withColumns(
        {
            "fm_mean_name": F.greatest("fm_edit", "fm_words", "fm_phonetic"),
            "fm_mean_address": sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / len(parts),
            "fm_max_contact": F.greatest(
                "fm_mean_email", "fm_mean_phone", "fm_mean_website", F.col("fm_mean_domain") * 0.5
            ),
        }
    )


def match_establishments(
    a: DataFrame,
    b: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All profile pairs of one country with ``match_quality >= threshold``.

    Inputs have ``id``, ``iso_code`` and :data:`FIELDS`. A row names both profiles, the
    smallest record id and the number of records behind each, the overall score, the
    dimension that contributed most (``match_quality_rule``) and the field scores. Join
    :func:`members` on the profile ids to list every record.
    """
    # Each side is used three times (word counts, keys, scores); compute it once.
    left, right = checkpointed(profiles(a)), checkpointed(profiles(b))
    pairs = candidate_pairs(left, right, weights, threshold)
    wide_a = left.select(*[F.col(c).alias("profile_a" if c == "profile_id" else f"a_{c}") for c in left.columns])
    wide_b = right.select(*[F.col(c).alias("profile_b" if c == "profile_id" else f"b_{c}") for c in right.columns])
    scored = field_scores(pairs.join(wide_a, "profile_a").join(wide_b, "profile_b"))
    parts = {
        "name": F.col("fm_mean_name") * weights["name"],
        "address": F.col("fm_mean_address") * weights["address"],
        "contact": F.col("fm_max_contact") * weights["contact"],
        "legal": F.col("fm_mean_legal_id") * weights["legal"],
    }
    best = F.greatest(*parts.values())
    rule = None
    for name, part in parts.items():
        rule = (F if rule is None else rule).when(part == best, F.lit(name))
    total = F.round(parts["name"] + parts["address"] + parts["contact"] + parts["legal"], 6)
    scores = [c for c in scored.columns if c.startswith("fm_")]
    return (
        scored.withColumn("match_quality", total)
        .where(F.col("match_quality") >= F.lit(threshold))
        .select(
            F.col("a_iso_code").alias("iso_code"),
            F.col("a_id").alias("id_source_1"),
            F.col("b_id").alias("id_source_2"),
            F.col("a_members").alias("n_id_source_1_matches"),
            F.col("b_members").alias("n_id_source_2_matches"),
            "profile_a",
            "profile_b",
            "match_quality",
            rule.alias("match_quality_rule"),
            *scores,
        )
    )


def top_matches(matches: DataFrame, by: Sequence[str] = ("profile_a",)) -> DataFrame:
    """The best match per profile of the first source."""
    from tidemark.operators.select import best_per_key

    return best_per_key(matches, list(by), ["-match_quality", "id_source_2"])




def match_records(
    matches: DataFrame, a: DataFrame, b: DataFrame, run_id: str, source_1: str, source_2: str, match_type: str = "fuzzy"
) -> DataFrame:
    """One row per record pair behind the profile matches, with the columns the SCD2 merge takes.

    ``_keyhash`` is MD5(source_1|id_source_1|source_2|id_source_2) and ``_rowhash`` covers
    every other column, so :func:`tidemark.operators.scd.scd2_merge` versions them. Records
    are expanded from profiles here, at the merge, and nowhere before.
    """
    from tidemark.functions.hashing import with_hashes

    left = members(a).select(F.col("id").alias("id_source_1"), F.col("profile_id").alias("profile_a"))
    right = members(b).select(F.col("id").alias("id_source_2"), F.col("profile_id").alias("profile_b"))
    scores = [c for c in matches.columns if c.startswith("fm_")]
    pairs = (
        matches.select("profile_a", "profile_b", "iso_code", "match_quality", "match_quality_rule", *scores)
        .join(left, "profile_a")
        .join(right, "profile_b")
        .select(
            F.lit(run_id).alias("run_id"),
            "iso_code",
            F.lit(source_1).alias("source_1"),
            F.lit(source_2).alias("source_2"),
            "id_source_1",
            "id_source_2",
            F.lit(match_type).alias("match_type"),
            "match_quality",
            "match_quality_rule",
            *scores,
        )
    )
    key = ["source_1", "id_source_1", "source_2", "id_source_2"]
    payload = [c for c in pairs.columns if c not in key and c != "run_id"]
    return with_hashes(pairs, key, payload)
