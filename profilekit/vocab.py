"""Fixed vocabularies of the profiles.

Everything here is a fixed value that results depend on; it is stated as
plain text in its natural order.
"""

from __future__ import annotations

# --- fixed values: the 21 interest columns of every profile, in output order ---
INTERESTS: tuple[str, ...] = (
    "entertainment",
    "technology",
    "shopping",
    "lifestyle",
    "business",
    "fashion",
    "tourism",
    "game",
    "finance",
    "female",
    "sports",
    "photography",
    "car",
    "beauty",
    "childcare",
    "movie",
    "funny",
    "health",
    "education",
    "music",
    "news",
)

# --- fixed values: the same 21 interests as the original labels, same order ---
INTEREST_LABELS: tuple[str, ...] = (
    "娱乐", "科技", "购物", "生活", "企业办公", "时尚", "旅游", "游戏", "财经", "女性", "体育",
    "摄影", "汽车", "美容", "母婴育儿", "电影", "搞笑", "健康", "教育", "音乐", "资讯",
)

# --- fixed values: columns a scored dictionary carries (13 scores), then the
# --- 8 interests it has no score for and that are filled with 0 ---
SCORED_INTERESTS: tuple[str, ...] = INTERESTS[:13]
ZERO_INTERESTS: tuple[str, ...] = INTERESTS[13:]

# --- fixed values: the coded-tag dictionary of the social log (code -> label) ---
SOCIAL_CODE_LABELS: tuple[tuple[str, str], ...] = (
    ("10001", "游戏"),
    ("10002", "汽车"),
    ("10003", "旅游"),
    ("10004", "生活"),
    ("10005", "娱乐"),
    ("10006", "体育"),
    ("10007", "电影"),
    ("10008", "时尚"),
    ("10009", "科技"),
    ("10010", "教育"),
    ("10011", "教育"),
    ("10012", "教育"),
    ("10013", "生活"),
    ("10014", "购物"),
)

# --- fixed value: divisor applied to every averaged score (its meaning is not stated) ---
SCORE_DIVISOR = 120.0

LABEL_TO_INTEREST: dict[str, str] = dict(zip(INTEREST_LABELS, INTERESTS))


def social_code_map() -> list[tuple[str, str]]:
    """The coded-tag dictionary with English interest names."""
    return [(code, LABEL_TO_INTEREST[label]) for code, label in SOCIAL_CODE_LABELS]
