"""Fixed values.

Words, labels, patterns and names that decide results.  They are data, not
logic, and must stay exactly as written (NFC, accents kept).
"""

# --- warranty text -> days -------------------------------------------------
LIFETIME_WARRANTY = "trọn đời"
LIFETIME_DAYS = 100 * 365
NO_WARRANTY_WORDS = ("không", "no warranty")
YEAR_WORDS = ("năm", "year")
MONTH_WORDS = ("tháng", "month")
DAY_WORDS = ("ngày", "day")
DAYS_PER_YEAR = 365
DAYS_PER_MONTH = 30

# --- membership-age text -> days -------------------------------------------
MEMBERSHIP_UNITS = {"năm": 365, "tháng": 30, "ngày": 1}

# --- default labels --------------------------------------------------------
NO_BRAND = "No Brand"
NO_WARRANTY = "Không bảo hành"

# --- return-policy code -> label -------------------------------------------
RETURN_POLICY_LABELS = {
    "any_reason": "Bất cứ lý do gì",
    "defective_product": "Sản phẩm hư hỏng",
    "no_return": "Không đổi trả",
}

# --- names looked up in the warranty list ----------------------------------
WARRANTY_PERIOD = "thời_gian_bảo_hành"
WARRANTY_TYPE = "hình_thức_bảo_hành"
WARRANTY_LOCATION = "nơi_bảo_hành"

# --- separators ------------------------------------------------------------
BREADCRUMB_SEPARATOR = " / "
ATTRIBUTE_SEPARATOR = ": "
LINE_SEPARATOR = "\n"

# --- category link: slug and number ----------------------------------------
CATEGORY_LINK = r"/([^/]+)/c(\d+)"

# --- document file names ---------------------------------------------------
PRODUCT_FILES = "product*.json"
SELLER_FILES = "seller*.json"
REVIEW_FILES = "reviews*.json"

# --- run report ------------------------------------------------------------
SUCCESS = "Success"
SKIPPED_EMPTY = "Skipped (Empty Source)"
SKIPPED_COLUMNS = "Skipped (Missing Column)"
FAILED = "Failed: "
