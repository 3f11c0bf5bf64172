"""Plain pandas/NumPy versions of the definitions, one cutoff or one vector at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd


def snapshot(lines: pd.DataFrame, cutoff, horizon: int, min_history: int, home: str):
    cutoff = pd.Timestamp(cutoff)
    past = lines[lines.invoice_date < cutoff]
    later = lines[(lines.invoice_date >= cutoff)
                  & (lines.invoice_date < cutoff + pd.Timedelta(days=horizon))]
    buyers = set(later.customer_id)
    out = []
    for customer, rows in past.groupby("customer_id"):
        orders = [(g.invoice_date.min(), g.line_revenue.sum(), g.quantity.sum(),
                   g.stock_code.nunique()) for _, g in rows.groupby("invoice_no")]
        if not orders:
            continue
        orders.sort(key=lambda o: o[0])
        dates = [o[0] for o in orders]
        value = np.array([o[1] for o in orders], dtype=float)
        n = len(orders)
        recency, tenure = (cutoff - dates[-1]).days, (cutoff - dates[0]).days
        if tenure < min_history:
            continue
        gaps = np.array([(b - a).days for a, b in zip(dates, dates[1:])], dtype=float)
        mean_gap = gaps.mean() if len(gaps) else np.nan
        std_gap = gaps.std(ddof=1) if len(gaps) > 1 else 0.0
        window = {}
        for days in (30, 60, 90, 180):
            inside = [d >= cutoff - pd.Timedelta(days=days) for d in dates]
            window[days] = (sum(inside), value[inside].sum())
        modes = rows.country.dropna().mode()
        is_home = int(len(modes) > 0 and modes.iat[0] == home)
        out.append({
            "customer_id": customer, "frequency": n, "monetary": value.sum(),
            "avg_order_value": value.mean(),
            "std_order_value": value.std(ddof=1) if n > 1 else 0.0,
            "max_order_value": value.max(), "avg_items": np.mean([o[2] for o in orders]),
            "avg_products": np.mean([o[3] for o in orders]), "recency_days": recency,
            "tenure_days": tenure, "revenue_per_tenure_day": value.sum() / max(tenure, 1),
            "mean_gap_days": mean_gap, "std_gap_days": std_gap,
            "min_gap_days": gaps.min() if len(gaps) else np.nan,
            "max_gap_days": gaps.max() if len(gaps) else np.nan,
            "gap_cv": std_gap / mean_gap if len(gaps) and mean_gap > 0 else np.nan,
            "recency_vs_gap": recency / max(mean_gap, 1) if len(gaps) else np.nan,
            **{f"orders_last_{d}d": w[0] for d, w in window.items()},
            **{f"revenue_last_{d}d": w[1] for d, w in window.items()},
            "order_momentum": window[30][0] / max(window[90][0], 1),
            "revenue_momentum": window[30][1] / max(window[90][1], 1),
            "orders_90d_vs_180d": window[90][0] / max(window[180][0], 1),
            "distinct_products": rows.stock_code.nunique(), "total_units": rows.quantity.sum(),
            "avg_unit_price": rows.unit_price.mean(),
            "products_per_order": rows.stock_code.nunique() / max(rows.invoice_no.nunique(), 1),
            "is_uk": is_home, "is_export": 1 - is_home,
            "label": int(customer in buyers), "cutoff": cutoff})
    return pd.DataFrame(out)


def order(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["score", "cutoff", "customer_id"], ascending=[False, True, True])


def average_precision(label, score) -> float:
    place = np.argsort(-score, kind="stable")
    label, score = label[place], score[place]
    last = np.r_[score[1:] != score[:-1], True]
    hits, rows = np.cumsum(label)[last], np.arange(1, len(label) + 1)[last]
    return float((np.diff(np.r_[0, hits]) * hits / rows).sum() / max(hits[-1], 1))


def roc_auc(label, score) -> float:
    pos, neg = score[label == 1], score[label == 0]
    if not len(pos) or not len(neg):
        return np.nan
    above = (pos[:, None] > neg[None]).sum() + (pos[:, None] == neg[None]).sum() / 2
    return float(above / len(pos) / len(neg))
