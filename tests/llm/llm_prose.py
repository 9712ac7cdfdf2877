"""Made-up prose for the tests."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n, vocabulary=300):
    """n words that look random and are the same each time."""
    state, words = seed * 7919 + 13, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        words.append(f"{WORDS[state // 7 % 20]}{state // 140 % vocabulary}")
    return " ".join(words)
