"""Formulas of alphas, written out in pandas from their published text, against the registered expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.factors import formulaic, registry

SF = "/root/testdata/sf0.001"
#: Rows of an entity before all windows are full.
WARM_UP = 130


def rank(x: pd.Series) -> pd.Series:
    return x.round(10).astype("float32").rank(pct=True)


def ts_rank(x: pd.Series, n: int) -> pd.Series:
    return x.round(10).astype("float32").rolling(n, min_periods=1).rank()


def corr(x: pd.Series, y: pd.Series, n: int) -> pd.Series:
    return x.rolling(n, min_periods=3).corr(y).replace([np.inf, -np.inf], 0).fillna(0)


def cov(x: pd.Series, y: pd.Series, n: int) -> pd.Series:
    return x.rolling(n, min_periods=3).cov(y).fillna(0)


def expected(d: pd.DataFrame) -> dict[str, pd.Series]:
    o, h, l, c, w, v = (d[k] for k in ("open", "high", "low", "close", "vwap", "volume"))  # noqa: E741
    v = v * 100
    ret = c.pct_change().fillna(0)
    adv20 = v.rolling(20, min_periods=1).mean()
    lowest, highest = l.rolling(12, min_periods=1).min(), h.rolling(12, min_periods=1).max()
    slow = c.rolling(100, min_periods=1).mean().diff(100) / c.shift(100)
    spread = (c - lowest) / (highest - lowest).replace(0, 0.0001)
    return {
        "alpha002": -corr(rank(np.log(v).diff(2)), rank((c - o) / o), 6),
        "alpha003": -corr(rank(o), rank(v), 10),
        "alpha013": -rank(cov(rank(c), rank(v), 5)),
        "alpha017": -rank(ts_rank(c, 10)) * rank(c.diff().diff()) * rank(ts_rank(v / adv20, 5)),
        "alpha024": (-(c - c.rolling(100, min_periods=1).min())).where(slow <= 0.05, -c.diff(3)),
        "alpha026": -corr(ts_rank(v, 5), ts_rank(h, 5), 5).rolling(3, min_periods=1).max(),
        "alpha027": 1 - 2 * (rank(corr(rank(v), rank(w), 6).rolling(2, min_periods=1).mean() / 2) > 0.5).astype(float),
        "alpha035": ts_rank(v, 32) * (1 - ts_rank(c + h - l, 16)) * (1 - ts_rank(ret, 32)),
        "alpha040": -rank(h.rolling(10, min_periods=2).std()) * corr(h, v, 10),
        "alpha043": ts_rank(v / adv20, 20) * ts_rank(-c.diff(7), 8),
        "alpha044": -corr(h, rank(v), 5),
        "alpha050": -rank(corr(rank(v), rank(w), 5)).rolling(5, min_periods=1).max(),
        "alpha055": -corr(rank(spread), rank(v), 6),
        "alpha101": (c - o) / (h - l + 0.001),
    } | _more(o, h, l, c, w, v, ret)


def _more(o, h, l, c, w, v, ret) -> dict[str, pd.Series]:  # noqa: E741
    roll = lambda x, n: x.rolling(n, min_periods=1)
    dev = lambda x, n: x.rolling(n, min_periods=2).std()
    adv = lambda n: roll(v, n).mean()
    scale = lambda x: x / x.abs().sum()
    below = lambda a, b: (a < b).astype(float)
    mix = lambda a, b, k: a * k + b * (1 - k)
    d, mid, over = c.diff(), (h + l) / 2, w - c
    signs = np.sign(d) + np.sign(d).shift(1) + np.sign(d).shift(2)
    spread = (h - l) / (roll(c, 5).sum() / 5)
    inside = ((c - l) - (h - c)) / (c - l).replace(0, 0.0001)
    return {
        "alpha005": rank(o - roll(w, 10).sum() / 10) * -rank(c - w).abs(),
        "alpha008": -rank((roll(o, 5).sum() * roll(ret, 5).sum()).diff(10)),
        "alpha010": rank(d.where((roll(d, 4).min() > 0) | (roll(d, 4).max() < 0), -d)),
        "alpha011": (rank(roll(over, 3).max()) + rank(roll(over, 3).min())) * rank(v.diff(3)),
        "alpha014": -rank(ret.diff(3)) * corr(o, v, 10),
        "alpha015": -roll(rank(corr(rank(h), rank(v), 3)), 3).sum(),
        "alpha016": -rank(cov(rank(h), rank(v), 5)),
        "alpha018": -rank(dev((c - o).abs(), 5) + (c - o) + corr(c, o, 10)),
        "alpha019": -np.sign(2 * c.diff(7)) * (1 + rank(1 + roll(ret, 250).sum())),
        "alpha021": below(adv(20), v).where(~(roll(c, 8).mean() + dev(c, 8) < roll(c, 2).mean()), 1.0) * 2 - 1,
        "alpha022": -corr(h, v, 5).diff(5) * rank(dev(c, 20)),
        "alpha025": rank(-ret * adv(20) * w * (h - c)),
        "alpha028": scale(corr(adv(20), l, 5) + mid - c),
        "alpha030": (1 - rank(signs)) * roll(v, 5).sum() / roll(v, 20).sum(),
        "alpha032": scale(roll(c, 7).mean() - c) + 20 * scale(corr(w, c.shift(5), 230)),
        "alpha034": rank(2 - rank((dev(ret, 2) / dev(ret, 5).replace(0, np.nan)).fillna(1)) - rank(d)),
        "alpha037": rank(corr((o - c).shift(1), c, 200)) + rank(o - c),
        "alpha038": -rank(ts_rank(o, 10)) * rank(c / o),
        "alpha052": -roll(l, 5).min().diff(5) * rank((roll(ret, 240).sum() - roll(ret, 20).sum()) / 220) * ts_rank(v, 5),
        "alpha053": -inside.diff(9),
        "alpha061": below(rank(w - roll(w, 16).min()), rank(corr(w, adv(180), 18))),
        "alpha064": -below(rank(corr(roll(mix(o, l, 0.178404), 13).mean(), roll(adv(120), 13).mean(), 17)), rank(mix(mid, w, 0.178404).diff(4))),
        "alpha065": -below(rank(corr(mix(o, w, 0.00817205), roll(adv(60), 9).mean(), 6)), rank(o - roll(o, 14).min())),
        "alpha068": -below(ts_rank(corr(rank(h), rank(adv(15)), 9), 14), rank(mix(c, l, 0.518371).diff())),
        "alpha074": -below(rank(corr(c, roll(adv(30), 37).mean(), 15)), rank(corr(rank(mix(h, w, 0.0261661)), rank(v), 11))),
        "alpha075": below(rank(corr(w, v, 4)), rank(corr(rank(l), rank(adv(50)), 12))),
        "alpha083": rank(spread.shift(2)) * rank(rank(v)) / (spread / over.replace(0, np.nan)).replace(0, np.nan),
        "alpha085": rank(corr(mix(h, c, 0.876703), adv(30), 10)) ** rank(corr(ts_rank(mid, 4), ts_rank(v, 10), 7)),
        "alpha086": -below(ts_rank(corr(c, roll(adv(20), 15).mean(), 6), 20), rank(c - w)),
        "alpha094": -(rank(w - roll(w, 12).min()) ** ts_rank(corr(ts_rank(w, 20), ts_rank(adv(60), 4), 18), 3)),
        "alpha095": below(rank(o - roll(o, 12).min()), ts_rank(rank(corr(roll(mid, 19).mean(), roll(adv(40), 19).mean(), 13)) ** 5, 12)),
        "alpha099": -below(rank(corr(roll(mid, 20).sum(), roll(adv(60), 20).sum(), 9)), rank(corr(l, v, 6))),
    }


@pytest.fixture(scope="module")
def panels(spark):
    bars = tm.bars_weekly(spark, SF).filter("entity <= 3")
    assert formulaic.ALPHAS
    names = list(expected(pd.DataFrame(np.ones((3, 6)), columns=["open", "high", "low", "close", "vwap", "volume"])))
    bars = bars.cache()
    parts = []
    for k in range(0, len(names), 9):  # small plans
        some = names[k : k + 9]
        parts.append(registry.compute_factors(bars, some).orderBy("entity", "dt").select("entity", *(F.col(n) for n in some)).toPandas())
    return bars.orderBy("entity", "dt").toPandas(), pd.concat([parts[0], *(x.drop(columns="entity") for x in parts[1:])], axis=1)


def test_alphas_by_their_formulas(panels):
    bars, made = panels
    for entity, own in bars.groupby("entity"):
        got = made[made["entity"] == entity].reset_index(drop=True)
        for name, want in expected(own.reset_index(drop=True).astype({"open": float})).items():
            a, b = got[name].to_numpy(float)[WARM_UP:], want.to_numpy(float)[WARM_UP:]
            assert len(a) > 100 and np.isclose(a, b, rtol=1e-6, atol=1e-7, equal_nan=True).mean() > 0.99, (name, np.isclose(a, b, rtol=1e-6, atol=1e-7, equal_nan=True).mean())
