"""Rows of a frame in an order that does not depend on the run."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
