"""Error-log triage (L1-L4): message, status guidance, config guidance.

Rules are small literal tables joined by status range (L2) and by substring
(L3, first matching rule wins via ``min_by(rule_no)``). Both rule tables are
fixed-size, so broadcasting them is bounded by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Per-status guidance. ``{P}`` is the product name,
# ``{PU}`` the product name upper-cased.
STATUS_RULES = [
    (401, 401, [
        "Confirm the PAT is valid, active, and issued for {P}.",
        "Check that --base-url or {PU}_BASE_URL points to the correct {P} host.",
        "If you use Keychain, env vars, or token files, confirm the CLI is reading the intended credential source.",
    ]),
    (403, 403, [
        "Check whether the PAT owner can access or edit the target object in the {P} web UI.",
        "If write allowlists are configured, verify the target is included in the approved spaces, pages, "
        "projects, or issue keys.",
        "If this is a write command, confirm the PAT owner has edit permission for the target content.",
    ]),
    (404, 404, [
        "Verify the base URL and identifier are correct, such as page ID, issue key, or attachment target page.",
        "Confirm the PAT owner can see the target object in the {P} web UI.",
        "If you exported content earlier, refresh from the live source before retrying.",
    ]),
    (409, 409, [
        "Refresh the live object and retry, because another edit may have changed the current version.",
        "For Confluence page updates, fetch the latest page before applying another write.",
    ]),
    (429, 429, [
        "The server asked you to slow down. Retry after a short delay.",
        "Reduce batch size, polling frequency, or repeated write attempts if you are automating a loop.",
    ]),
    (500, 599, [
        "The Atlassian server returned a transient failure. Retry after a short delay.",
        "If the error persists, check whether the {P} instance is degraded or unavailable.",
    ]),
]

# Configuration-error rules (substrings of the lower-cased
# message, first match wins) and their guidance.
CONFIG_RULES = [
    (["missing confluence token", "missing jira token"], [
        "Provide a PAT with --token, a token file, or env or Keychain settings for the target product.",
        "If you expected Keychain lookup to work, verify the configured service and account names exist on "
        "this machine.",
    ]),
    (["missing confluence base url", "missing jira base url"], [
        "Set the base URL with --base-url, an env var, or local agent.env before retrying.",
        "Make sure the URL points at the product root, not a specific page or issue path.",
    ]),
    (["write blocked"], [
        "The CLI safety allowlist rejected this target before any API write happened.",
        "Check CONFLUENCE_ALLOWED_* or JIRA_ALLOWED_* values in your local config and expand them only if this "
        "target is intentionally approved.",
    ]),
    (["--allow-write or --dry-run"], [
        "Use --dry-run to preview the change first, or add --allow-write to execute it intentionally.",
    ]),
    (["update-page requires at least one"], [
        "Provide a title change, a replacement body, or appended content before retrying update-page.",
    ]),
    (["replace-section target heading"], [
        "Check that the heading text exists exactly once on the live Confluence page before retrying "
        "replace-section.",
        "For the first iteration, replace-section is safest on text-first pages with clear heading structure.",
    ]),
    (["move-page requires different"], [
        "Choose a different parent page before retrying move-page.",
    ]),
    (["failed to parse confluence storage html fragment"], [
        "Check that the replacement input converts into valid Confluence storage HTML.",
        "If the source is Markdown, retry with simpler text-first content before using macro-heavy input.",
    ]),
]

FILE_HINT = "Check that the referenced local file exists and that the path is correct on this machine."
JSON_HINT = "Check that the JSON input is valid, especially fields files and inline JSON arguments."
GUIDANCE_SEP = " | "


def status_rules(spark: SparkSession) -> DataFrame:
    rows = [(lo, hi, GUIDANCE_SEP.join(h)) for lo, hi, h in STATUS_RULES]
    return spark.createDataFrame(rows, "lo INT, hi INT, template STRING")


def config_rules(spark: SparkSession) -> DataFrame:
    rows = [(i, pat, GUIDANCE_SEP.join(h)) for i, (pats, h) in enumerate(CONFIG_RULES) for pat in pats]
    return spark.createDataFrame(rows, "rule_no INT, pattern STRING, guidance STRING")


def error_message(product: str | None = None):
    """L1: payload ``message``, else ``errorMessages`` joined by '; ', else the
    product default; a non-JSON payload is tolerated (stays text)."""
    msg = F.get_json_object("payload", "$.message")
    errs = F.from_json(F.get_json_object("payload", "$.errorMessages"), "array<string>")
    default = F.concat(F.coalesce(F.col("product"), F.lit(product or "")), F.lit(" API request failed"))
    return (F.when(F.coalesce(msg, F.lit("")) != "", msg)
            .when(F.coalesce(F.size(errs), F.lit(0)) > 0, F.array_join(errs, "; "))
            .otherwise(default))


def triage(errors: DataFrame) -> DataFrame:
    """L4: ``(error_id, error_type, status_code, message, guidance)``.

    API errors (``error_type`` ApiError) get L1's message and L2's status
    guidance; ``ConfigError`` rows get L3's first matching rule; file and
    JSON errors get their fixed hint.
    """
    e = errors.withColumn("message", F.when(F.col("error_type") == "ApiError", error_message())
                          .otherwise(F.col("message")))
    prod, code, text = F.col("product"), F.col("status_code"), F.lower(F.col("message"))
    status_g = F.lit(None).cast("string")
    for lo, hi, hints in reversed(STATUS_RULES):
        filled = F.replace(F.replace(F.lit(GUIDANCE_SEP.join(hints)), F.lit("{PU}"), F.upper(prod)), F.lit("{P}"), prod)
        status_g = F.when(code.between(lo, hi), filled).otherwise(status_g)
    config_g = F.lit(None).cast("string")
    for patterns, hints in reversed(CONFIG_RULES):
        hit = reduce(Column.__or__, [F.instr(text, p) > 0 for p in patterns])
        config_g = F.when(hit, F.lit(GUIDANCE_SEP.join(hints))).otherwise(config_g)
    guidance = (F.when(F.col("error_type") == "ApiError", status_g)
                .when(F.col("error_type") == "ConfigError", config_g)
                .when(F.col("error_type") == "FileNotFoundError", F.lit(FILE_HINT))
                .when(F.col("error_type") == "JSONDecodeError", F.lit(JSON_HINT)))
    return e.select("error_id", "product", "error_type", "status_code", "message", guidance.alias("guidance"))
