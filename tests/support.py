"""What several test modules use."""

import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
