"""Automated audits of stored records against current pages, review suggestions, and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.functions import text as X
from lanternflow.functions import urls as U


def check(verdict: str | Column, note: str | Column) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(lit(verdict).alias("verdict"), lit(note).alias("note"))


def _listed(names: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(F.array_sort(names), ","), F.lit("")), F.lit("none"))


def _signals(evidence: Column) -> Column:
    return F.coalesce(F.transform(evidence, lambda e: e["signal"]), F.array().cast("array<string>"))


def check_platform(available: Column, score: Column, passed: Column, evidence: Column, stored: Column) -> Column:
    names = _signals(evidence)
    told = F.concat(F.lit("current score "), score.cast("string"), F.lit(", signals "), _listed(names), F.lit("; stored "), _listed(stored))
    return (
        F.when(~available, check("UNCERTAIN", "homepage unavailable"))
        .when(passed & (F.size(names) >= 2), check("PASS", told))
        .when(score > 0, check("UNCERTAIN", F.concat(F.lit("weak current evidence; "), told)))
        .otherwise(check("FAIL", F.concat(F.lit("reachable homepage has no current evidence; "), told)))
    )


def check_country(available: Column, score: Column, passed: Column, evidence: Column, detected_state: Column) -> Column:
    names = _signals(evidence)
    strong = F.array_intersect(names, F.array(*map(F.lit, vocab.STRONG_COUNTRY_SIGNALS)))
    strong = F.concat(strong, F.when(detected_state.isNotNull(), F.array(F.concat(F.lit("contextual_business_state:"), detected_state))).otherwise(F.array().cast("array<string>")))
    told = F.concat(F.lit("current score "), score.cast("string"), F.lit("; strong evidence "), _listed(strong), F.lit("; all signals "), _listed(names))
    return (
        F.when(~available, check("UNCERTAIN", "country evidence unavailable"))
        .when(passed & (F.size(strong) > 0), check("PASS", told))
        .when(score > 0, check("UNCERTAIN", F.concat(F.lit("only weak current evidence; "), told)))
        .otherwise(check("FAIL", F.concat(F.lit("reachable pages have no current evidence; "), told)))
    )


def check_logo(available: Column, stored: Column, width: Column, height: Column, current: Column, markup: Column) -> Column:
    """width, height: what current markup declares for the stored logo, null if it isn't there."""
    path = F.lower(U.path_of(stored))
    tiny = F.coalesce(width.between(1, 32) & height.between(1, 32), F.lit(False))
    key = U.asset_key(stored)
    return (
        F.when(X.missing(stored), check("MISSING", "no stored logo URL"))
        .when(~stored.rlike("^https?://") | path.rlike(vocab.REJECT_LOGO), check("FAIL", "stored logo is a favicon, app, payment, or malformed asset"))
        .when(path.rlike(vocab.NOT_A_LOGO), check("FAIL", "stored logo URL appears to be a product or social asset"))
        .when(~available, check("UNCERTAIN", "stored logo could not be rechecked"))
        .when(tiny, check("FAIL", "stored logo has tiny declared dimensions"))
        .when(F.coalesce(U.asset_key(current) == key, F.lit(False)), check("PASS", "stored logo matches the current candidate"))
        .when(F.coalesce(markup.contains(stored) | markup.contains(key), F.lit(False)), check("UNCERTAIN", "stored logo remains in page markup"))
        .otherwise(check("UNCERTAIN", "stored logo no longer matches the current candidate"))
    )


def check_state(available: Column, stored: Column, detected: Column) -> Column:
    gone = X.missing(stored)
    return (
        F.when(~available, check("UNCERTAIN", "business state could not be rechecked"))
        .when(gone & detected.isNull(), check("MISSING", "no stored state and no current one"))
        .when(gone, check("FAIL", F.concat(F.lit("stored state is empty but evidence indicates "), detected)))
        .when(F.coalesce(detected == stored, F.lit(False)), check("PASS", F.concat(F.lit("stored state confirmed: "), stored)))
        .when(detected.isNotNull(), check("FAIL", F.concat(F.lit("stored state "), stored, F.lit(" conflicts with "), detected)))
        .otherwise(check("UNCERTAIN", F.concat(F.lit("stored state "), stored, F.lit(" has no confirmation"))))
    )


def check_contacts(available: Column, emails: Column, phones: Column, current_emails: Column, current_phones: Column) -> Column:
    empty = F.array().cast("array<string>")
    lowered = F.transform(emails, lambda e: F.lower(e))
    invalid = F.filter(emails, lambda e: ~X.normalize_email(e).eqNullSafe(F.lower(e)))
    gone = F.array_except(lowered, F.coalesce(current_emails, empty))
    cut = F.array_except(phones, F.coalesce(current_phones, empty))
    part = lambda name, a: F.when(F.size(a) > 0, F.concat(F.lit(name), F.array_join(F.array_sort(a), ",")))
    issues = F.concat_ws("; ", part("invalid emails: ", invalid), part("stored emails not found: ", gone), part("stored phones not found: ", cut))
    return (
        F.when(~available, check("UNCERTAIN", "stored contacts could not be rechecked"))
        .when(issues != "", check("FAIL", issues))
        .when((F.size(emails) == 0) & (F.size(phones) == 0), check("UNCERTAIN", "no stored contacts to confirm"))
        .otherwise(check("PASS", F.concat(F.lit("confirmed "), F.size(emails).cast("string"), F.lit(" email(s) and "), F.size(phones).cast("string"), F.lit(" phone(s)"))))
    )


def check_socials(available: Column, stored: Column, current: Column) -> Column:
    """Both structs of five urls.  Invalid ones fail before availability is asked for."""
    kept = F.filter(F.array(*[F.struct(F.lit(p).alias("platform"), F.nullif(stored[p], F.lit("")).alias("url"), current[p].alias("now")) for p in vocab.PLATFORMS]), lambda s: s["url"].isNotNull())
    invalid = F.transform(F.filter(kept, lambda s: ~U.social_profile(s["url"])["platform"].eqNullSafe(s["platform"])), lambda s: s["url"])
    gone = F.transform(F.filter(kept, lambda s: ~U.social_profile(s["url"])["url"].eqNullSafe(s["now"])), lambda s: U.social_profile(s["url"])["url"])
    return (
        F.when(F.size(kept) == 0, check("MISSING", "no stored social profile URLs"))
        .when(F.size(invalid) > 0, check("FAIL", F.concat(F.lit("invalid social URLs: "), F.array_join(invalid, ","))))
        .when(~available, check("UNCERTAIN", "stored social profiles could not be rechecked"))
        .when(F.size(gone) > 0, check("UNCERTAIN", F.concat(F.lit("valid profiles not found on current pages: "), F.array_join(gone, ","))))
        .otherwise(check("PASS", F.concat(F.lit("confirmed "), F.size(kept).cast("string"), F.lit(" profile link(s)"))))
    )


def audit_confidence(available: Column, verdicts: dict[str, Column]) -> Column:
    every = list(verdicts.values())
    sound = (verdicts["shopify"] == "PASS") & (verdicts["india"] == "PASS") & (verdicts["contacts"] == "PASS")
    sound = sound & verdicts["logo"].isin("PASS", "MISSING") & verdicts["state"].isin("PASS", "MISSING")
    return (
        F.when(~available | X.any_of([v == "FAIL" for v in every]), "LOW")
        .when(X.any_of([v == "UNCERTAIN" for v in every]), "MEDIUM")
        .when(sound, "HIGH")
        .otherwise("MEDIUM")
    )


def audited(records: DataFrame, current: DataFrame) -> DataFrame:
    """The audit worksheet: a row for each record.

    records: domain, shopify_score, india_score, category, tagline_or_description, state, logo_url, emails, phones,
    socials, shopify_evidence, india_evidence (arrays of structs with signal).  current: domain, available, markup and,
    for platform and country, score, passed and evidence, then state, logo, logo_width, logo_height, emails, phones,
    socials of the pages as they are now; no row: unavailable."""
    now = current.select("domain", *[F.col(c).alias(f"now_{c}") for c in current.columns if c != "domain"])
    a = F.coalesce("now_available", F.lit(False))
    zero = lambda c: F.coalesce(c, F.lit(0))
    no = lambda c: F.coalesce(c, F.lit(False))
    checks = {
        "shopify": check_platform(a, zero("now_platform_score"), no("now_platform_passed"), F.col("now_platform_evidence"), _signals(F.col("shopify_evidence"))),
        "india": check_country(a, zero("now_country_score"), no("now_country_passed"), F.col("now_country_evidence"), F.col("now_state")),
        "logo": check_logo(a, F.col("logo_url"), F.col("now_logo_width"), F.col("now_logo_height"), F.col("now_logo"), F.col("now_markup")),
        "state": check_state(a, F.col("state"), F.col("now_state")),
        "contacts": check_contacts(a, F.col("emails"), F.col("phones"), F.col("now_emails"), F.col("now_phones")),
        "socials": check_socials(a, F.col("socials"), F.col("now_socials")),
    }
    out = records.join(now, "domain", "left").select("*", a.alias("__a"), *[c.alias(f"__{k}") for k, c in checks.items()])
    json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    out = out.withColumns({
        "pipeline_status": F.lit("ACCEPTED"),
        **{c: F.coalesce(c, F.lit("")) for c in ("category", "tagline_or_description", "state", "logo_url")},
        **{c: json(F.col(c)) for c in ("emails", "phones", "socials", "shopify_evidence", "india_evidence")},
        **{f"auto_{k}_check": F.col(f"__{k}.verdict") for k in checks},
        "auto_audit_confidence": audit_confidence(F.col("__a"), {k: F.col(f"__{k}.verdict") for k in checks}),
        "auto_audit_notes": F.concat_ws(" | ", *[F.concat(F.lit(f"{k}: "), F.col(f"__{k}.note")) for k in checks]),
        **{c: F.lit("") for c in vocab.MANUAL_COLUMNS},
    })
    return out.select(*vocab.AUTO_COLUMNS)


def suggested(audits: DataFrame) -> DataFrame:
    """audits with what a reviewer may answer, notes and a priority; manual columns stay as they are."""
    word = {"PASS": "yes", "FAIL": "no", "MISSING": "missing", "UNCERTAIN": "uncertain"}
    of = lambda c: X.lookup(word, F.col(f"auto_{c}_check"))
    emails, phones = X.json_list(F.col("emails")), X.json_list(F.col("phones"))
    none = (F.size(emails) == 0) & (F.size(phones) == 0)
    odd = (F.size(phones) > 5) | F.exists(emails, lambda e: F.lower(e).endswith(".comin"))
    no_state = X.missing(F.col("state")) & F.col("auto_state_check").isin("MISSING", "UNCERTAIN")
    out = audits.withColumns({
        "suggested_shopify": of("shopify"),
        "suggested_india": of("india"),
        "suggested_logo": of("logo"),
        "suggested_state": F.when(no_state, "missing").otherwise(of("state")),
        "suggested_contacts": F.when(none, "missing").when(odd, "uncertain").otherwise(of("contacts")),
    })
    notes = F.concat_ws(
        "; ",
        F.when(no_state, "state absent; no reliable contextual business state"),
        F.when(none, "no stored merchant contacts").when(odd, "contact set is anomalous and needs review").when(F.col("auto_contacts_check") == "PASS", "stored contacts were confirmed").otherwise("stored contacts could not be reconfirmed"),
        F.when(F.col("suggested_logo") == "no", "logo evidence conflicts or is invalid").when(F.col("suggested_logo") == "missing", "no stored logo URL"),
        F.when(F.col("suggested_india") == "uncertain", "country evidence is unavailable or weak").when(F.col("suggested_india") == "yes", "country evidence includes a strong signal"),
    )
    said = F.array(*vocab.SUGGESTION_COLUMNS[:5])
    high = (F.col("auto_audit_confidence") == "LOW") | F.array_contains(said, "no") | X.any_of([F.col(f"suggested_{c}") == "uncertain" for c in ("shopify", "india", "contacts")])
    medium = (F.col("auto_audit_confidence") == "MEDIUM") | F.exists(said, lambda s: s.isin("missing", "uncertain"))
    return out.withColumns({"suggested_notes": notes, "review_priority": F.when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")})


def changed_manual_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose manual columns differ: must be empty."""
    columns = ("domain", *vocab.MANUAL_COLUMNS)
    return before.select(*columns).exceptAll(after.select(*columns))


def invalid_verdicts(audits: DataFrame, checks: Sequence[str]) -> DataFrame:
    return audits.where(X.any_of([~F.coalesce(F.col(c).isin(*vocab.VERDICTS), F.lit(False)) for c in checks]))


def quality(export: DataFrame, minimum_rows: int = 1000, platform_threshold: int = 4, country_threshold: int = 4) -> DataFrame:
    """check, passed, detail: of a public export (all columns text).  Score checks only where the columns exist."""
    d = F.trim(F.coalesce("domain_url", F.lit("")))
    origin = U.normalize_domain(d)
    key = U.registered_domain(origin)
    lists = {k: F.from_json("contacts", "emails array<string>, phones array<string>")[k] for k in ("emails", "phones")}
    social = F.from_json("socials", "map<string,string>")
    bad_json = X.malformed_json(F.col("contacts")) | X.malformed_json(F.col("socials"))
    repeated = X.any_of([F.coalesce(F.size(a) != F.size(F.array_distinct(a)), F.lit(False)) for a in lists.values()])
    bad_socials = F.aggregate(F.array(*[F.coalesce(U.submitted_social_bad(p, social[p]), F.lit(False)).cast("int") for p in vocab.PLATFORMS]), F.lit(0), lambda a, x: a + x)
    strangers = F.size(F.filter(F.coalesce(F.map_entries(social), F.expr("cast(array() as array<struct<key:string,value:string>>)")), lambda e: ~e["key"].isin(*vocab.PLATFORMS) & (F.coalesce(e["value"], F.lit("")) != "")))
    count = lambda c: F.count(F.when(c, 1))
    measured = {
        "rows": F.count(F.lit(1)), "empty": count(d == ""), "invalid": count(origin.isNull()), "keys": F.count(key), "distinct": F.count_distinct(key),
        "logos": count(U.forbidden_logo(F.col("logo_url"))), "json": count(bad_json), "repeated": count(repeated & ~bad_json), "socials": F.coalesce(F.sum(F.when(~bad_json, bad_socials + strangers)), F.lit(0)),
    }
    scored = {"shopify_score", "india_score"} <= set(export.columns)
    if scored:
        low = (F.col("shopify_score").cast("string").try_cast("int") >= platform_threshold) & (F.col("india_score").cast("string").try_cast("int") >= country_threshold)
        measured["scores"] = count(~F.coalesce(low, F.lit(False)))
    one = export.agg(*[c.alias(k) for k, c in measured.items()])
    absent = [c for c in vocab.REQUIRED_COLUMNS if c not in export.columns]
    text = lambda c, s: F.concat(F.col(c).cast("string"), F.lit(s))
    rows = [
        ("Required columns", F.lit(not absent), F.lit(", ".join(absent))),
        ("CSV row count", F.col("rows") >= minimum_rows, text("rows", f" rows; target >= {minimum_rows}")),
        ("Non-empty domains", F.col("empty") == 0, text("empty", " empty")),
        ("Valid domain URLs", F.col("invalid") == 0, text("invalid", " invalid")),
        ("Unique domains", F.col("keys") == F.col("distinct"), F.lit("")),
        ("Logo validation", F.col("logos") == 0, text("logos", " forbidden icons")),
        ("JSON-in-CSV fields", F.col("json") == 0, text("json", " malformed rows")),
        ("Deduplicated contacts", F.col("repeated") == 0, text("repeated", " affected rows")),
        ("Social profile URLs", F.col("socials") == 0, text("socials", " share URLs")),
    ]
    if scored:
        rows.append(("Verification thresholds", F.col("scores") == 0, text("scores", " invalid rows")))
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), p.alias("passed"), t.alias("detail")) for n, p, t in rows])))


def file_checks(readme: str | None, present: dict[str, bool]) -> list[tuple[str, bool, str]]:
    """Checks of files beside the export: which are there, and which topics the readme leaves out."""
    gone = [t for t in vocab.README_TOPICS if t not in (readme or "").lower()]
    return [(n, p, "") for n, p in present.items()] + [("README methodology", not gone, "missing: " + ", ".join(gone) if gone else "all required topics found")]


def render_checks(rows: Sequence[tuple[str, bool, str]]) -> str:
    lines = [f"{n:.<32}{'PASS' if p else 'FAIL'}{'  ' + t if t else ''}" for n, p, t in rows]
    return "\n".join([*lines, "", f"FINAL STATUS: {'READY' if rows and all(p for _, p, _ in rows) else 'NOT READY'}"])


def validation(export: DataFrame) -> DataFrame:
    """One row: defect counters, and completeness of each required column."""
    d = F.trim(F.coalesce("domain_url", F.lit("")))
    key = U.registered_domain(U.normalize_domain(d))
    count = lambda c: F.count(F.when(c, 1))
    gone = {c: X.missing(F.col(c)) | (F.col(c).isin("[]", "{}")) for c in vocab.REQUIRED_COLUMNS}
    return export.agg(
        F.count(F.lit(1)).alias("rows"), count(U.normalize_domain(d).isNull()).alias("invalid_domains"), (F.count(key) - F.count_distinct(key)).alias("duplicate_domains"),
        count(U.forbidden_logo(F.col("logo_url"))).alias("bad_logos"), count(X.malformed_json(F.col("contacts"))).alias("bad_contacts"), count(X.malformed_json(F.col("socials"))).alias("bad_socials"),
        *[count(c).alias(f"missing_{k}") for k, c in gone.items()],
    )
