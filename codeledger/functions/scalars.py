"""Column expressions; all run inside whole-stage codegen, none is a UDF."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"
DAY_MICROS = 86_400_000_000

# Folders skipped when looking for Gradle versions, and the
# wider set skipped when looking for Gradle builds.
VERSION_SCAN_EXCLUDED_DIRS = [".gradle", "build", "out", "target", ".git", ".idea"]
BUILD_SCAN_EXCLUDED_DIRS = VERSION_SCAN_EXCLUDED_DIRS + [".settings", "bin"]

# Gradle files that may state a version.
GRADLE_WRAPPER_PATH = "gradle/wrapper/gradle-wrapper.properties"
GRADLE_FILE_NAMES = [
    "build.gradle",
    "build.gradle.kts",
    "settings.gradle",
    "settings.gradle.kts",
    "gradle.properties",
]

# Runtime label per build tool.
RUNTIME_LABELS = {
    "gradle": "Java",
    "maven": "Java",
    "npm": "Node.js",
    "yarn": "Node.js",
    "poetry": "Python",
    "pipenv": "Python",
    "pip": "Python",
    "go": "Go",
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def non_empty(c: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(c, F.lit(""))


def as_timestamp(value: datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def python_round(c: Column, digits: int) -> Column:
    """Round to ``digits`` places the way Python does: on the exact binary value,
    ties to even (Spark's own ``round`` works on the decimal text, half up)."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c.cast("double"), F.lit(pattern)).cast("double")


def iso_timestamp(c: Column) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    c = c.cast("timestamp")
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    return F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != 0, F.date_format(c, ".SSSSSS")).otherwise(F.lit("")),
    )


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Days, rounded towards the past, from ``earlier`` to ``later``."""
    span = F.unix_micros(as_timestamp(later)) - F.unix_micros(as_timestamp(earlier))
    return ((span - F.pmod(span, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("bigint")


def activity_status(last_commit: Column, as_of: datetime | str | Column) -> Column:
    days = whole_days_between(as_timestamp(as_of), last_commit)
    return F.when(days > 365, F.lit("INACTIVE")).otherwise(F.lit("ACTIVE"))


def is_recent(ts: Column, as_of: datetime | str | Column) -> Column:
    return ts.cast("timestamp") >= as_timestamp(as_of) - F.expr("interval 365 days")


def size_class(size_bytes: Column, total_loc: Column) -> Column:
    size = F.coalesce(size_bytes.cast("double"), F.lit(0.0))
    loc = F.coalesce(total_loc.cast("bigint"), F.lit(0))
    return (
        F.when((loc < 100) & (size < 1e6), "Empty/Minimal")
        .when(loc < 100, "Docs/Data")
        .when(size < 1e6, "Tiny")
        .when(size < 1e7, "Small")
        .when(size < 1e8, "Medium")
        .when(size < 1e9, "Large")
        .otherwise("Massive")
    )


def megabytes(size_bytes: Column) -> Column:
    return python_round(F.coalesce(size_bytes.cast("double"), F.lit(0.0)) / F.lit(1_000_000), 2)


def years(days: Column) -> Column:
    return python_round(days.cast("double") / F.lit(365), 2)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` (at least one), two places."""
    ratio = part.cast("double") / F.greatest(whole.cast("double"), F.lit(1.0))
    return python_round(ratio * F.lit(100), 2)


def or_default(c: Column, default: str | int) -> Column:
    return F.coalesce(c, F.lit(default))


def package_coordinate(group: Column, artifact: Column, name: Column) -> Column:
    both = (F.coalesce(group, F.lit("")) != "") & (F.coalesce(artifact, F.lit("")) != "")
    # concat_ws, unlike concat, is never NULL: joins on the name then add no
    # null filter, and both uses of one dependency list can share a shuffle
    return F.when(both, F.concat_ws(":", group, artifact)).otherwise(or_default(name, "Unknown"))


def first_path(locations: Column) -> Column:
    return F.coalesce(F.get(locations, F.lit(0)).getField("path"), F.lit("N/A"))


def joined_field(items: Column, field: str) -> Column:
    """``field`` of every struct in ``items`` as ", "-separated text."""
    names = F.transform(items, lambda x: F.coalesce(x.getField(field), F.lit("Unknown")))
    return F.coalesce(F.array_join(names, ", "), F.lit(""))


def text_or_list(raw: Column) -> Column:
    """A JSON value read as text: a list becomes ", "-separated, text stays."""
    as_list = F.from_json(raw, "array<string>")
    listed = F.when(raw.startswith("["), F.array_join(as_list, ", "))
    return F.coalesce(listed, raw, F.lit(""))


def percent_text(c: Column) -> Column:
    """``70.5%`` as a double, NULL when it is not a number."""
    number = F.btrim(c, F.lit("%"))
    return F.when(
        number.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), number.try_cast("double")
    )


def normalized_language(c: Column) -> Column:
    return F.lower(strip(c))


def language_is(c: Column, languages: str | list[str]) -> Column:
    wanted = [languages] if isinstance(languages, str) else list(languages)
    return normalized_language(c).isin([w.strip().lower() for w in wanted])


def without_qualifier(version: Column) -> Column:
    return F.substring_index(version, "-", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Folder of a relative path, empty for the root."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def in_excluded_dir(path: Column, excluded: list[str]) -> Column:
    return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(d) for d in excluded]))


def in_git_dir(path: Column) -> Column:
    return path.rlike(r"(^|/)\.git/")


def is_gradle_wrapper(path: Column) -> Column:
    return (path == GRADLE_WRAPPER_PATH) | path.endswith("/" + GRADLE_WRAPPER_PATH)


def is_gradle_file(path: Column) -> Column:
    return is_gradle_wrapper(path) | basename(path).isin(GRADLE_FILE_NAMES)


def runtime_label(tool: Column) -> Column:
    name = F.lower(F.coalesce(non_empty(tool), F.lit("Unknown")))
    label = None
    for runtime in dict.fromkeys(RUNTIME_LABELS.values()):
        tools = [t for t, r in RUNTIME_LABELS.items() if r == runtime]
        label = F.when(name.isin(tools), runtime) if label is None else label.when(name.isin(tools), runtime)
    return label.otherwise("Unknown")


def runtime_entry(tool: Column, runtime_version: Column) -> Column:
    version = F.coalesce(non_empty(runtime_version), F.lit("Unknown"))
    return F.concat(runtime_label(tool), F.lit(":"), version)


def maven_purl(group: Column, artifact: Column, version: Column) -> Column:
    """Package URL; the version part is left out when ``version`` is NULL."""
    suffix = F.coalesce(F.concat(F.lit("@"), version), F.lit(""))
    return F.concat(F.lit("pkg:maven/"), group, F.lit("/"), artifact, suffix)


def artifact_key(purl: Column, name: Column, version: Column) -> Column:
    fallback = F.concat(or_default(name, "None"), F.lit("@"), or_default(version, "None"))
    return F.coalesce(non_empty(purl), fallback)


def ssh_clone_url(
    url: Column, host: Column, bitbucket_host: str | None = None, gitlab_host: str | None = None
) -> Column:
    """``struct<url, error>``: the ssh form of a clone URL, or why there is none."""
    github = r"^https://github\.com/([^/]+)/(.+?)(\.git)?$"
    bitbucket = r"^https://([^/]+)/scm/([^/]+)/(.+?)(\.git)?$"
    gitlab = r"^https://([^/]+)/([^/]+(?:/[^/]+)*)/(.+?)(\.git)?$"
    is_github = host == "github.com"
    is_bitbucket = (host == bitbucket_host) if bitbucket_host else F.lit(False)
    is_gitlab = (host == gitlab_host) if gitlab_host else F.lit(False)
    is_ssh = url.startswith("ssh://") | url.startswith("git@")
    no_host = F.coalesce(host, F.lit("")) == ""

    def bad(text: str) -> Column:
        return F.concat(F.lit(text + ": "), F.coalesce(url, F.lit("None")))

    ssh = (
        F.when(no_host, None)
        .when(is_ssh, url)
        .when(is_github & url.rlike(github), F.regexp_replace(url, github, "git@github.com:$1/$2.git"))
        .when(is_github, None)
        .when(
            is_bitbucket & url.rlike(bitbucket),
            F.regexp_replace(url, bitbucket, r"ssh://git@$1:7999/$2/$3.git"),
        )
        .when(is_bitbucket, None)
        .when(is_gitlab & url.rlike(gitlab), F.regexp_replace(url, gitlab, "git@$1:$2/$3.git"))
    )
    error = (
        F.when(no_host, F.lit("repo.host_name is required"))
        .when(is_ssh, None)
        .when(F.coalesce(~url.startswith("https://"), F.lit(True)), bad("Unsupported URL format"))
        .when(is_github & ~url.rlike(github), bad("URL not recognized as a valid GitHub URL"))
        .when(is_bitbucket & ~url.rlike(bitbucket), bad("URL not recognized as a valid Bitbucket URL"))
        .when(is_gitlab & ~url.rlike(gitlab), bad("URL not recognized as a valid GitLab URL"))
        .when(
            ~(is_github | is_bitbucket | is_gitlab),
            F.concat(F.lit("Unsupported host_name '"), host, F.lit("' for URL: "), url),
        )
    )
    return F.struct(ssh.alias("url"), error.alias("error"))
