"""The fit of problem 10 uses as many ordinary segments as before the check."""

from wattlake.llm import abuse


def test_ordinary_segments_up_to_the_bound(monkeypatch):
    used = []

    class Seen(abuse.KneserNey):
        def fit(self, texts):
            used.append((len(texts["plain"]), self.bits))
            return super().fit({y: t[:50] for y, t in texts.items()})

    monkeypatch.setattr(abuse, "KneserNey", Seen)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(17_000)]
    abuse.fit([("\n".join(f"the {w} meter reads well" for w in words), False)], rounds=0)
    assert used == [(len(set(words)), 20)] and len(set(words)) > 15_000
