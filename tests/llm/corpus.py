"""Small corpora with copies, shared passages, empty and odd texts."""

import random

WORDS = [a + b + c for a in "bdgklmnprst" for b in "aeiou" for c in ("", "n", "r", "sto", "vel")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def text(rng, lines=4, words=20):
    return "\n".join(sentence(rng, words) + "." for _ in range(lines))


def corpus(seed=1, n=40):
    """Rows (doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    texts = [text(rng, rng.randint(1, 6), rng.randint(8, 30)) for _ in range(n)]
    passage = text(rng, 3, 25)
    texts += [texts[0], texts[0], texts[1]]  # exact copies
    texts += [t.replace(t.split()[5], "changed", 1) for t in texts[2:8]]  # near copies
    texts += [sentence(rng, 12) + "\n" + passage + "\n" + sentence(rng, 9) for _ in range(6)]
    texts += [None, "", "  \n\t ", "one", "a b c", "the the the the the the", "x" * 900, "Ünï çödé\r\nline\x0bbreak", text(rng, 60, 30), "same line here\n" * 30]
    rows = [(k, t, "en", f"src{k % 3}" if k % 7 else None, len(t or "")) for k, t in enumerate(texts)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
