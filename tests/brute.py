"""Plain-Python reference implementations used as test oracles."""

from __future__ import annotations


def confusion(y, p, t):
    tp = sum(1 for a, b in zip(y, p) if a == 1 and b >= t)
    fp = sum(1 for a, b in zip(y, p) if a == 0 and b >= t)
    fn = sum(1 for a, b in zip(y, p) if a == 1 and b < t)
    tn = sum(1 for a, b in zip(y, p) if a == 0 and b < t)
    return tn, fp, fn, tp


def rates(y, p, t):
    tn, fp, fn, tp = confusion(y, p, t)
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
    return precision, recall, f1


def average_precision(y, p):
    positives = sum(y)
    if positives == 0:
        return 0.0
    total, last_recall = 0.0, 0.0
    for s in sorted(set(p), reverse=True):
        tn, fp, fn, tp = confusion(y, p, s)
        recall = tp / positives
        total += (recall - last_recall) * (tp / (tp + fp))
        last_recall = recall
    return total


def roc_auc(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    if not pos or not neg:
        return None
    wins = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def grid():
    step = (0.99 - 0.01) / 98
    values = [i * step + 0.01 for i in range(99)]
    values[-1] = 0.99
    return values


def select_threshold(y, p):
    best_t, best_key = 0.5, (-1.0, -1.0, -1.0)
    for t in grid():
        precision, recall, f1 = rates(y, p, t)
        key = (f1, recall, -abs(t - 0.5))
        if key > best_key:
            best_key, best_t = key, t
    return best_t
