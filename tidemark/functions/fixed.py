"""Fixed values.

These constants must equal the ones the original workflow uses, or results differ.
They are stated plainly, in their natural order, and nothing else lives here.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES — industry classification codes and names (36 codes).
# Unknown codes resolve to the code itself.
# ---------------------------------------------------------------------------
INDUSTRY_CODE_MAP: dict[str, str] = {
    "01": "水泥工業",
    "02": "食品工業",
    "03": "塑膠工業",
    "04": "紡織纖維",
    "05": "電機機械",
    "06": "電器電纜",
    "08": "玻璃陶瓷",
    "09": "造紙工業",
    "10": "鋼鐵工業",
    "11": "橡膠工業",
    "12": "汽車工業",
    "14": "建材營造",
    "15": "航運業",
    "16": "觀光餐旅",
    "17": "金融保險",
    "18": "貿易百貨",
    "19": "綜合",
    "20": "其他",
    "21": "化學工業",
    "22": "生技醫療業",
    "23": "油電燃氣業",
    "24": "半導體業",
    "25": "電腦及週邊設備業",
    "26": "光電業",
    "27": "通信網路業",
    "28": "電子零組件業",
    "29": "電子通路業",
    "30": "資訊服務業",
    "31": "其他電子業",
    "32": "文化創意業",
    "33": "農業科技業",
    "34": "電子商務",
    "35": "綠能環保",
    "36": "數位雲端",
    "37": "運動休閒",
    "38": "居家生活",
}

# FIXED VALUES — industry used for an article whose stock has no industry.
DEFAULT_INDUSTRY = "其他"

# FIXED VALUES — market names, in source priority order.
MARKET_LISTED = "TWSE_LISTED"
MARKET_OTC = "TPEX_OTC"
MARKET_EMERGING = "TPEX_EMERGING"

# FIXED VALUES — offset between the ROC calendar year and the Gregorian year.
ROC_YEAR_OFFSET = 1911

# FIXED VALUES — numeric texts that mean "no value".
NUMERIC_NULL_TEXTS = ["", "--", "----", "N/A"]

# FIXED VALUES — suffix removed from an industry-chain page title ("industry chain introduction").
CHAIN_TITLE_SUFFIX = "產業鏈簡介"

# FIXED VALUES — CSV cell texts that a pandas reader turns into a missing value
# (the pandas default ``na_values`` list).
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# FIXED VALUES — topic levels and the number of topics cut at each.
LEVELS: dict[str, int] = {"medium": 25, "fine": 60}

# FIXED VALUES — best-k search ranges (upper bound exclusive); the fine search
# starts no lower than medium k + 3.
AUTO_RANGES: dict[str, tuple[int, int]] = {"medium": (8, 30), "fine": (20, 60)}
FINE_MIN_GAP = 3

# FIXED VALUES — sizes used by the topic brief and keyword extraction.
N_KEYWORDS = 15
N_SAMPLES = 3
SAMPLE_CHARS = 80
N_TOP_INDUSTRIES = 3

# FIXED VALUES — search hits kept per (stock, board).
MAX_PER_STOCK = 10

# FIXED VALUES — neighbours in the cosine graph; reduced dimensions; merges shown.
N_NEIGHBORS = 30
REDUCED_DIMS = 15
LAST_MERGES = 60

# FIXED VALUES — topic tree: root id, root label, root color, node id prefixes,
# fallback color, and the industry palette (35 colors, used by sorted index modulo 35).
ROOT_ID = "All"
ROOT_LABEL = "全部文章"
ROOT_COLOR = "#ffffff"
INDUSTRY_PREFIX = "ind|"
MEDIUM_PREFIX = "med|"
FINE_PREFIX = "fin|"
FALLBACK_COLOR = "#cccccc"
INDUSTRY_PALETTE = [
    "#4C78A8", "#F58518", "#E45756", "#72B7B2", "#54A24B",
    "#EECA3B", "#B279A2", "#FF9DA6", "#9D755D", "#BAB0AC",
    "#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd",
    "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf",
    "#aec7e8", "#ffbb78", "#98df8a", "#ff9896", "#c5b0d5",
    "#c49c94", "#f7b6d2", "#c7c7c7", "#dbdb8d", "#9edae5",
    "#6baed6", "#fd8d3c", "#74c476", "#9e9ac8", "#e7969c",
]

# FIXED VALUES — Python's whitespace set (str.isspace), written as a regex class body
# that both Java regex and RE2 read the same way.
PY_WHITESPACE_CLASS = (
    r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# FIXED VALUES — characters kept by the article cleaner: CJK unified ideographs,
# letters, digits/numerals and underscore (Python's ``\w``), plus whitespace.
CJK_RANGE_CLASS = r"\x{4E00}-\x{9FFF}"
WORD_CLASS = CJK_RANGE_CLASS + r"\p{L}\p{N}_"

# FIXED VALUES — JSON field names of the two company-list vocabularies.
LIST_VOCAB_ZH = {"code": "公司代號", "short": "公司簡稱", "full": "公司名稱",
                 "as_of": "出表日期", "industry": "產業別"}
LIST_VOCAB_EN = {"code": "SecuritiesCompanyCode", "short": "CompanyAbbreviation",
                 "full": "CompanyName", "as_of": "Date", "industry": "SecuritiesIndustryCode"}

# FIXED VALUES — JSON field names of the two daily-quote vocabularies.
QUOTE_VOCAB_EXCHANGE = {"code": "Code", "close": "ClosingPrice", "change": "Change",
                        "volume": "TradeVolume", "date": "Date"}
QUOTE_VOCAB_OTC = {"code": "SecuritiesCompanyCode", "close": "Close", "change": "Change",
                   "volume": "TradingShares", "date": "Date"}

# FIXED VALUES — quote columns added to the stock list, with their types.
QUOTE_COLUMNS = [("close_price", "double"), ("change_val", "string"), ("change_pct", "string"),
                 ("volume", "bigint"), ("quote_date", "string")]
