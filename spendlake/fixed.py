"""Results depend on these being exactly as they are."""

# Category given to a spend name that no keyword matches.
DEFAULT_TYPE_ID = 20
DEFAULT_TYPE = "etc"
DEFAULT_WEIGHT = 0

# Audit names.
BATCH_USER = "batch"
SNAPSHOT_USER = "SYSTEM"

# Search.
BM25_K1 = 1.2
BM25_B = 0.75
HITS_PER_NAME = 10

# Reports.
DETAIL_ROWS_PER_REPORT = 10_000
REPORT_HOUR = 9
MONTHLY_TITLE = "월간 소비 리포트"
WEEKLY_TITLE = "주간 소비 리포트"
NO_DETAIL_TEXT = "소비 내역이 없습니다."
NO_CATEGORY_TEXT = "카테고리 데이터가 없습니다."
SUBJECT_TAIL = "소비 내역"
CURRENCY_SUFFIX = " 원"
COLOR_UP = "#e53935"
COLOR_DOWN = "#43a047"
COLOR_SAME = "#888888"

# HTML of report rows and of the period summary; upper-case names in braces are filled in.
CELL = '<td style="padding:8px 12px;border-bottom:1px solid #eee;">'
MONEY_CELL = '<td style="padding:8px 12px;border-bottom:1px solid #eee;text-align:right;">'
EMPTY_ROW = '<tr><td colspan="{{WIDTH}}" style="padding:8px 12px;text-align:center;color:#888;">{{TEXT}}</td></tr>'
SUMMARY = (
    '<table style="width:100%;border-collapse:collapse;margin-top:16px;"><thead><tr style="background:#f0f4ff;">'
    '<th style="padding:8px 12px;text-align:right;color:#555;font-weight:600;">이번 기간 총소비</th>'
    '<th style="padding:8px 12px;text-align:right;color:#555;font-weight:600;">지난 기간 총소비</th>'
    '<th style="padding:8px 12px;text-align:right;color:#555;font-weight:600;">등락</th></tr></thead><tbody><tr>'
    '<td style="padding:8px 12px;text-align:right;">{{CURRENT}}</td>'
    '<td style="padding:8px 12px;text-align:right;">{{PREVIOUS}}</td>'
    '<td style="padding:8px 12px;text-align:right;color:{{COLOR}};font-weight:bold;">{{CHANGE}}</td>'
    "</tr></tbody></table>"
)

# Price feeds.
OVERSEAS_CURRENCY = "USD"
QUOTE_OK = "0"
HOLIDAY_OK = "00"

# Column types of the search index.
INDEX_MAPPING = {
    "mappings": {
        "properties": {
            "spent_idx": {"type": "long"},
            "spent_name": {"type": "text"},
            "spent_money": {"type": "long"},
            "spent_at": {"type": "date"},
            "user_seq": {"type": "long"},
            "consume_keyword_type_id": {"type": "long"},
            "consume_keyword_type": {"type": "text", "fields": {"keyword": {"type": "keyword"}}},
            "room_seq": {"type": "long"},
            "user_id": {"type": "keyword"},
            "card_alias": {"type": "keyword"},
        }
    }
}
