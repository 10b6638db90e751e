from test_neardup import brute


def brute_components(rows, k, num, den):
    """id -> smallest id of its group, by comparing all pairs."""
    return {i: c for i, (_, c) in brute(rows, k, num, den).items()}
