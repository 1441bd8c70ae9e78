"""Schemas and the small fixed dimensions of the article archive."""

from __future__ import annotations

MEDIA_FIELDS = ("type", "url", "alt", "caption", "provider")
SCALAR_FIELDS = ("article_id", "url", "category", "title", "publish_date", "author", "content")

MEDIA_DDL = "array<struct<type:string,url:string,alt:string,caption:string,provider:string>>"
ARTICLE_DDL = (
    ", ".join(f"{name} string" for name in SCALAR_FIELDS)
    + f", tags array<string>, media {MEDIA_DDL}"
)
ARTICLE_COLUMNS = (*SCALAR_FIELDS, "tags", "media")

# Rows per Parquet row group.
ROW_GROUP_ROWS = 5000

# Month names as they occur in publish dates.
MONTH_NUMBERS = {
    "يناير": "01",
    "فبراير": "02",
    "مارس": "03",
    "أبريل": "04",
    "مايو": "05",
    "يونيو": "06",
    "يوليو": "07",
    "أغسطس": "08",
    "سبتمبر": "09",
    "أكتوبر": "10",
    "نوفمبر": "11",
    "ديسمبر": "12",
}

# Section key -> label stored in the category column.
CATEGORY_LABELS = {
    "arab": "عرب",
    "art": "فن",
    "caricature": "كاريكاتير",
    "economy": "اقتصاد و بورصة",
    "investigations": "تحقيقات",
    "television": "تلفزيون",
    "urgent": "عاجل",
    "your_horoscope_today": "حظك اليوم",
}

# Section key, path prefix (taken literally, the page number is
# appended to it), first and last page.
SECTIONS = (
    ("arab", "/Section/أخبار-عربية/88/", 1, 9705),
    ("art", "/Section/فن/48/1", 1, 7566),
    ("caricature", "/Section/كاريكاتير-اليوم/192/", 1, 305),
    ("economy", "/Section/اقتصاد-وبورصة/297/", 1, 9221),
    ("investigations", "/Section/تحقيقات-وملفات/12/", 1, 8820),
    ("politics", "/Section/سياسة/319/", 1, 6946),
    ("reports", "/Section/تقارير-مصرية/97/", 6947, 15815),
    ("television", "/Section/تليفزيون/251/", 1, 4756),
    ("urgent", "/Section/أخبار-عاجلة/65/", 6000, 9999),
    ("your_horoscope_today", "/Section/حظك-اليوم/330/", 1, 1228),
)
SECTION_DDL = "section string, path string, lo long, hi long"

# Section keys with a seed page for incremental runs.
SEED_SECTIONS = ("urgent",)
