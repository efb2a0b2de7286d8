"""A small averaged perceptron over named features."""

from __future__ import annotations

import random
from collections import defaultdict


class AveragedPerceptron:
    """Multi-class; weights are averaged over all steps of training."""

    def __init__(self, classes: tuple[str, ...]):
        self.classes = classes
        self.weights: dict[str, dict[str, float]] = {}

    def scores(self, features: list[str]) -> dict[str, float]:
        out = dict.fromkeys(self.classes, 0.0)
        for f in features:
            for c, w in self.weights.get(f, {}).items():
                out[c] += w
        return out

    def predict(self, features: list[str]) -> tuple[str, float]:
        """The best class and its lead over the first class; the first class wins ties."""
        s = self.scores(features)
        best = max(self.classes, key=s.__getitem__)
        return best, s[best] - s[self.classes[0]]

    def train(self, examples: list[tuple[list[str], str]], rounds: int = 6, seed: int = 7) -> AveragedPerceptron:
        total: dict[tuple[str, str], float] = defaultdict(float)
        stamp: dict[tuple[str, str], int] = defaultdict(int)
        order, step = list(range(len(examples))), 0
        shuffle = random.Random(seed).shuffle
        for _ in range(rounds):
            shuffle(order)
            for k in order:
                features, truth = examples[k]
                step += 1
                guess, _ = self.predict(features)
                if guess == truth:
                    continue
                for f in features:
                    row = self.weights.setdefault(f, {})
                    for c, change in ((truth, 1.0), (guess, -1.0)):
                        total[f, c] += (step - stamp[f, c]) * row.get(c, 0.0)
                        stamp[f, c] = step
                        row[c] = row.get(c, 0.0) + change
        for f, row in self.weights.items():
            for c in row:
                total[f, c] += (step - stamp[f, c]) * row[c]
                row[c] = total[f, c] / max(step, 1)
        return self
