"""Fixed values that must be equal to those the data were made with, and defaults."""

# --- fixed values: unified schema, in order (name here, Korean label, Spark type) ---
UNIFIED = [
    ("company_key", "회사키", "string"),
    ("biz_reg_no", "사업자등록번호", "string"),
    ("company_name", "회사명", "string"),
    ("company_name_raw", "회사명_원본", "string"),
    ("representative", "대표자", "string"),
    ("industry_code", "업종_KSIC", "string"),
    ("industry_name", "업종명_원본", "string"),
    ("province", "시도", "string"),
    ("district", "시군구", "string"),
    ("road_address", "도로명주소", "string"),
    ("lot_address", "지번주소", "string"),
    ("phone", "대표전화", "string"),
    ("homepage", "홈페이지", "string"),
    ("employees", "종업원수", "double"),
    ("capital", "자본금", "double"),
    ("revenue", "매출액", "double"),
    ("registered_on", "등록일", "string"),
    ("operating_status", "가동상태", "string"),
    ("source_dataset_id", "출처_데이터셋ID", "string"),
    ("source_page_url", "출처_URL", "string"),
    ("source_ids", "출처_목록", "string"),
    ("category", "카테고리", "string"),
    ("collected_on", "수집일", "string"),
]
UNIFIED_COLUMNS = [name for name, _, _ in UNIFIED]
KOREAN_LABEL = {name: label for name, label, _ in UNIFIED}

# --- fixed values: categories, quotas ---
MANUFACTURING = "제조"
IT = "IT_SW_벤처"
SERVICES = "도소매_콘텐츠_전문서비스"
CONSTRUCTION = "건설_물류_시설"
CATEGORIES = [MANUFACTURING, IT, SERVICES, CONSTRUCTION]
QUOTAS = {MANUFACTURING: 300, IT: 120, SERVICES: 520, CONSTRUCTION: 260}

# --- fixed values: registries, best trusted first, and the category each stands for ---
REGISTRIES = [
    ("15105482", MANUFACTURING),
    ("15057023", MANUFACTURING),
    ("15052274", IT),
    ("innobiz", IT),
    ("15118569", SERVICES),
    ("15086381", SERVICES),
    ("15099307", SERVICES),
    ("15065485", CONSTRUCTION),
    ("15071341", CONSTRUCTION),
]
SOURCE_PRIORITY = {name: rank for rank, (name, _) in enumerate(REGISTRIES, 1)}
UNKNOWN_PRIORITY = 99
SOURCE_CATEGORY = dict(REGISTRIES)

# --- fixed values: two-digit industry divisions (first, last, category) ---
INDUSTRY_RANGES = [
    (10, 33, MANUFACTURING),
    (58, 63, IT),
    (41, 42, CONSTRUCTION),
    (49, 52, CONSTRUCTION),
    (74, 75, CONSTRUCTION),
    (45, 47, SERVICES),
    (70, 73, SERVICES),
    (90, 91, SERVICES),
]

# --- fixed values: the provinces by the two syllables an address starts with ---
PROVINCES = {
    "서울": "서울특별시", "부산": "부산광역시", "대구": "대구광역시", "인천": "인천광역시",
    "광주": "광주광역시", "대전": "대전광역시", "울산": "울산광역시", "세종": "세종특별자치시",
    "경기": "경기도", "강원": "강원특별자치도", "충북": "충청북도", "충남": "충청남도",
    "전북": "전북특별자치도", "전남": "전라남도", "경북": "경상북도", "경남": "경상남도",
    "제주": "제주특별자치도",
}
#: Full spellings that don't start with the short form; used with extended=True.
PROVINCE_SPELLINGS = {
    "충청북도": "충청북도", "충청남도": "충청남도", "전라북도": "전북특별자치도",
    "전라남도": "전라남도", "경상북도": "경상북도", "경상남도": "경상남도",
}
METRO_PROVINCES = ["서울특별시", "경기도", "인천광역시"]
ACTIVE_STATUSES = ["가동중", "가동", "정상"]
STATUS_NAMES = {"영업중": "가동중", "영업/정상": "가동중", "폐업": "폐업", "휴업": "휴업"}

# --- fixed values: legal forms and marks that don't belong to a company's name ---
LEGAL_FORMS = ["주식회사", "유한회사", "사단법인", "재단법인", "합자회사", "합명회사",
               "(주)", "(유)", "(사)", "(재)", "(합)"]
SQUARE_LEGAL_FORM = "㈜"
NAME_MARKS = "()（）「」『』[]<>《》\"'.,·•"

# --- fixed values: sampling ---
SEED = 42
METRO_SHARE = 0.6
HEAD_FACTOR = 1.2
INDUSTRY_CAP = 0.05
DECILE_MIN_ROWS = 10

# --- fixed values: attempts ---
STATUSES = ["collected", "not_found", "failed", "skipped"]
MAX_RETRY = 2
STATUS_PRECEDENCE = ["collected", "skipped", "not_found", "failed"]
FLAG_PREFIX = "[AI 필터링 걸림] "
FLAG_MARK = "AI 필터링 걸림"

# --- fixed values: e-mail discovery limits ---
MAX_VISITS = 6
MAX_EMAILS = 15
MAX_CONTACT_LINKS = 5
MAX_PICKS = 2
BINARY_SUFFIXES = [".pdf", ".jpg", ".png", ".gif", ".zip"]
UNUSABLE_HOMEPAGES = ["http://", "http:// ", "https://", "http://www.", "", "nan"]
CONTACT_WORDS = ["contact", "about", "company", "introduction", "연락", "문의", "회사소개", "오시는길", "개요"]
CONTACT_STOPWORDS = ["privacy", "personal", "policy", "term"]
ENGINES = [("naver_webkr", 10), ("naver_local", 5), ("google_cse", 10), ("duckduckgo", 5)]
SITE_ENGINE = ("duckduckgo_site", 5)

# --- fixed values: e-mail syntax, scores ---
EMAIL_PATTERN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
DOMAIN_ENDINGS = ["co.kr", "com", "net", "kr"]
SCORE_DOMAIN_MATCH = 50
SCORE_HOMEPAGE = 30
SCORE_BUSINESS_LOCAL = 20
SCORE_PERSONAL_LOCAL = 10
SCORE_FREE_MAIL = -5
SCORE_FLAGGED = -100
SCORE_MALFORMED = -999
BUSINESS_LOCALS = ["biz", "sales", "info", "contact", "ceo", "marketing", "cs", "support", "service",
                   "inquiry", "admin", "business", "trade", "export", "import", "office", "sal"]
FREE_MAIL_DOMAINS = ["naver.com", "gmail.com", "hanmail.net", "daum.net", "nate.com", "hotmail.com",
                     "outlook.com", "outlook.kr", "yahoo.com", "yahoo.co.kr"]
NEWS_WORDS = ["news", "press", "daily", "times", "journal", "today"]
ACADEMIC_SUFFIXES = [".ac.kr", ".edu"]
BLOG_HOSTS = ["blog.naver.com", "m.blog.naver.com", "tistory.com", "brunch.co.kr", "medium.com",
              "velog.io", "linkedin.com", "kr.linkedin.com"]

# --- fixed values: blocklists ---
BLOCKED_LOCALS = ["noreply", "no-reply", "donotreply", "do-not-reply", "example", "test", "email",
                  "yourname", "yourid", "abc", "xxx", "privacy", "personal", "admin", "webmaster", "master"]
BLOCKED_EMAIL_DOMAINS = [
    "example.com", "domain.com", "yourdomain.com", "test.com", "email.com", "company.com", "sentry.io",
    "wixpress.com", "godo.co.kr", "cafe24.com", "saramin.co.kr", "happycampus.com", "jobkorea.co.kr",
    "albamon.com", "incruit.com", "work.go.kr", "kreditjob.com", "catch.co.kr", "114.co.kr",
    "kakaopage.com", "kakao.com", "kakaocorp.com", "tiktok.com", "instagram.com", "facebook.com",
    "youtube.com", "twitter.com", "x.com", "korea.kr", "go.kr", "fnnews.com", "yna.co.kr", "ikld.kr",
    "keris.or.kr", "sankun.com", "marketbz.com", "itdonga.com", "carestore.co.kr", "rndcircle.io",
    "goodsoftware.co.kr", "teamblind.com", "daangn.com", "inven.co.kr", "dkpia.com", "lab-t.net",
    "ntrex.co.kr", "esgroup.net", "theinvest.co.kr", "investnews.co.kr", "dable.io",
    "companymarket.co.kr", "happyhaksul.com", "biztop.co.kr", "composecoffee.co.kr", "sportsseoul.com",
    "koit.co.kr", "hanbat.ac.kr", "skuniv.ac.kr", "sejungilbo.com", "aitimes.kr", "smartcity.or.kr",
    "daangnservice.com", "urlquery.net", "boannews.com", "apple-economy.com", "irobotnews.com",
    "etnews.com", "ablenews.co.kr", "theindigo.co.kr", "fpn119.co.kr", "newstown.co.kr",
    "cosinkorea.com", "techsuda.com", "zdnet.co.kr", "ruliweb.com", "op.gg", "blog.yeogie.com",
    "radiokorea.com", "surfshark.com", "surfsharkbiz.com", "surfsharkpress.com", "bagelchat.ai",
    "cookiedeal.io", "aving.net",
]
BLOCKED_URL_PARTS = [
    "saramin.co.kr", "jobkorea.co.kr", "albamon.com", "incruit.com", "work.go.kr", "catch.co.kr",
    "happycampus.com", "114.co.kr", "bizno.net", "kreditjob.com", "nicebizinfo.com", "rocketpunch.com",
    "wanted.co.kr", "jobplanet.co.kr", "tiktok.com", "instagram.com", "facebook.com", "youtube.com",
    "twitter.com", "x.com", "fnnews.com", "yna.co.kr", "ikld.kr", "korea.kr", "go.kr", "keris.or.kr",
    "inven.co.kr", "sejungilbo.com", "aitimes.kr", "hellodd.com", "sportsseoul.com", "koit.co.kr",
    "msn.com", "namsieon.com", "sankun.com", "marketbz.com", "g2bmarket.com", "ksaco.kr", "sw.or.kr",
    "spo.go.kr", "factory.kjuso.kr", "myfactory.co.kr", "eep.energy.or.kr", "nursing.snu.ac.kr",
    "linkonbiz.com", "ourtoday.co.kr", "daont.co.kr", "babechat.ai", "m.frangfrang.com",
    "rome2rio.com", "goodsoftware.co.kr", "devicemart.co.kr", "namu.wiki", "play.google.com",
    "prezi.com", "changeok.co.kr", "worker.co.kr", "celtic.co.kr", "biztop.co.kr", "happyhaksul.com",
    "companymarket.co.kr", "haesola.com", "composecoffee.com", "smartcitysolutionmarket.com",
    "app.rndcircle.io", "ubique.co.kr", "oncore.co.kr", "roadmine.com", "daangn.com", "hanbat.ac.kr",
    "skuniv.ac.kr", "boannews.com", "apple-economy.com", "irobotnews.com", "etnews.com",
    "ablenews.co.kr", "theindigo.co.kr", "fpn119.co.kr", "newstown.co.kr", "cosinkorea.com",
    "techsuda.com", "zdnet.co.kr", "ruliweb.com", "op.gg", "blog.yeogie.com", "radiokorea.com",
    "surfshark.com",
]
NOISE_SOURCE_DOMAINS = [
    "it.donga.com", "itdonga.com", "zdnet.co.kr", "aitimes.kr", "etnews.com", "newstown.co.kr",
    "investnews.co.kr", "kihoilbo.co.kr", "hellodd.com", "sejungilbo.com", "cosinkorea.com",
    "techsuda.com", "inven.co.kr", "ruliweb.com", "rome2rio.com", "play.google.com", "prezi.com",
    "namu.wiki", "urlquery.net", "sankun.com", "marketbz.com", "g2bmarket.com", "daangn.com",
    "companymarket.co.kr", "biztop.co.kr", "happyhaksul.com", "devicemart.co.kr", "changeok.co.kr",
    "worker.co.kr", "celtic.co.kr", "sportsseoul.com", "msn.com", "namsieon.com", "composecoffee.com",
]

# --- fixed values: column aliases of user spreadsheets, by priority ---
NAME_ALIASES = ["회사명", "업체명", "기업명", "기업체명", "상호", "상호명", "법인명", "사업체명",
                "수행기관명", "수행기관", "기관명", "company", "name"]
ADDRESS_ALIASES = ["주소", "공장주소", "도로명주소", "지번주소", "소재지", "address", "addr"]
HOMEPAGE_ALIASES = ["홈페이지", "홈페이지주소", "웹사이트", "url", "homepage", "website"]
