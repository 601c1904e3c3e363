"""What several test modules share."""


def rows(frame):
    """Rows as plain tuples, sorted."""
    collected = [tuple(row) for row in frame.collect()]
    return sorted(collected, key=lambda r: tuple((v is None, str(v)) for v in r))
