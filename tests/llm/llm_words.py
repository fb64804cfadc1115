"""Invented languages."""

PARTS = {"nord": ("sk", "ør", "al", "en", "fj", "vik"), "sud": ("ta", "ri", "go", "lla", "ño", "es"), "ost": ("prz", "ow", "ski", "cze", "ny", "ię")}


def sentence(rng, lang):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 30)))
