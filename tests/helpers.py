"""Small constructors shared by the tests."""

from __future__ import annotations

from codeledger import schemas


def repo_files(spark, *entries):
    """(path, content[, repo_id]) entries as ``repo_files``."""
    rows = []
    for entry in entries:
        path, content, *repo = entry
        rows.append((repo[0] if repo else "r", path, len(content or ""), content))
    return spark.createDataFrame(rows, schemas.REPO_FILES)


def reports(spark, tool, *bodies):
    """One report per body, for repositories r0, r1, ..."""
    return spark.createDataFrame([(f"r{i}", tool, body) for i, body in enumerate(bodies)], schemas.REPORTS)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
