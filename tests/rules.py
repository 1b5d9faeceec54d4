"""Plain rules that the tests hold results against."""


def compare(a: dict, b: dict) -> int:
    """-1 if metric record ``a`` ranks above ``b``, 1 if below, 0 if tied."""
    gaps = [(a["roc_auc"] - b["roc_auc"], 0.005, True)]
    gaps += [(a[k] - b[k], 1e-6, False) for k in ("f1_score", "recall")]
    gaps.append((b["training_time"] - a["training_time"], 1e-6, False))
    for gap, least, equal_counts in gaps:
        if abs(gap) > least or (equal_counts and abs(gap) == least):
            return -1 if gap > 0 else 1
    return 0


def by_wins(records: list[dict]) -> list[str]:
    wins = {r["model_name"]: sum(compare(r, o) == -1 for o in records) for r in records}
    return [r["model_name"] for r in sorted(records, key=lambda r: (-wins[r["model_name"]], -r["roc_auc"], r["model_name"]))]
