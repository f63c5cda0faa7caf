"""Values that results depend on, stated once. All of them are fixed values."""

# Hosts of applicant-tracking boards.
BOARD_HOSTS = (
    "greenhouse.io", "lever.co", "ashbyhq.com", "workdayjobs.com", "myworkdayjobs.com", "smartrecruiters.com", "workable.com", "rippling.com",
    "bamboohr.com", "jobvite.com", "icims.com", "recruitee.com", "teamtailor.com", "personio.com", "successfactors.com", "breezy.hr", "aaimtrack.com",
    "applicantstack.com", "applytojob.com", "jobs.gem.com", "pinpointhq.com", "breathehr.com", "paylocity.com", "saashr.com", "ultipro.com",
    "careers.hibob.com", "careerpuck.com", "hire.trakstar.com", "trinethire.com", "workforcenow.adp.com", "oraclecloud.com",
)
# Hosts of outlets that report on funding.
FUNDING_HOSTS = ("businesswire.com", "prnewswire.com", "globenewswire.com", "sec.gov", "techcrunch.com", "reuters.com", "finsmes.com", "venturebeat.com", "crunchbase.com", "pitchbook.com", "builtin.com")
# Hosts of social networks and review sites.
SOCIAL_HOSTS = ("facebook.com", "instagram.com", "linkedin.com", "x.com", "twitter.com", "youtube.com", "tiktok.com", "glassdoor.com", "g2.com")
# Endings of assets.
ASSET_ENDINGS = (".css", ".js", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".ico", ".pdf", ".zip", ".mp4", ".mov", ".woff", ".woff2", ".ttf", ".eot")
# Names of tracking parameters.
TRACKING_PARAM = r"utm_[a-z0-9_]*|gclid|wbraid|gbraid|yclid|fbclid|msclkid|mc_cid|mc_eid|igshid|spm|_hsenc|_hsmi"
# First labels of hosts that carry a careers site.
CAREERS_HOST = r"^(jobs?|careers?|apply|talent|recruiting|work)\."
# Page types by what a path contains, first match first; the second of careers is a whole segment.
PAGE_TYPES = (
    ("careers", r"career|job|recruit|karriere"),
    ("careers", r"(^|/)(open-positions?|open-roles?|current-openings?|vacancies)(/|$)"),
    ("news", r"news|press|media|blog"),
    ("security", r"security|trust|compliance"),
    ("procurement", r"procurement|vendor|legal"),
    ("company", r"about|company|team"),
)
# Wording of links that leads to no page of a type, and that leads to careers.
LINK_NOISE = r"career-sites?|talent-acquisition|candidate-experience|event-recruiting|/solutions/recruiters|college-career|licensing-opportunities|equal-opportunities-policy|financial-services|get-involved|join-a-group"
CAREER_PHRASES = r"job openings|open roles|open positions|current openings|employment opportunities|join us|join our team|work with us|view jobs|view openings|view current career opportunities|採用|募集"
CAREER_WORDS = r"\b(careers?|jobs?|opportunities|vacancies|karriere|stellenangebote)\b"
RECRUITMENT_WORDS = r"\b(recruit|recruitment|vacancies|openings?|open positions?|job listings?)\b"
LINK_TYPES = (("news", r"news|press|media|blog"), ("security", r"security|trust|compliance"), ("procurement", r"procurement|vendor|supplier|legal"), ("company", r"about|company|team"))
# Marks of anti-robot pages and of client-side applications.
CHALLENGE_TITLE = r"(?i)<title[^>]*>\s*(?:just a moment|checking your browser|attention required!|access (?:to this page )?(?:has been )?denied|are you a human|please verify you are a human)"
CHALLENGE_MARKS = ("_cf_chl_opt", "/cdn-cgi/challenge-platform", "challenges.cloudflare.com", "ct.captcha-delivery.com", "client.px-cdn.net")
SPA_ROOT = r"(?i)<div[^>]+id=[\"'](?:root|app|__next|___gatsby)[\"']"
FILTER_WORDS = r"(?i)\b(?:filters?|clear (?:all )?filters|all departments?|all teams?|all locations?|any locations?|all offices?|all contract types?|all job types?|all categories|show only)\b"
ZERO_STATE = r"(?i)\b(?:no|zero|0)\s+(?:current\s+|open\s+)?(?:jobs?|roles?|positions?|openings?|vacancies|results?)\b"
STRONG_CAREERS = r"(?i)\b(open roles?|open positions?|job openings?|current openings?|open jobs?|job listings?|job vacancies|vacancies|greenhouse|lever|ashby|workday|smartrecruiters|full[- ]time|part[- ]time|employment type)\b|採用|募集要項|職種"
WEAK_CAREERS = r"(?i)\b(careers?|jobs?|join our team|work with us|we'?re hiring|hiring|apply)\b|採用|募集"
DETAIL_ANCHOR = r"(?i)href=[\"'][^\"']*(?:/job/|/jobs/[^\"'?#/]|/positions?/[^\"'?#]|/openings?/[^\"'?#]|/vacanc|gh_jid=|/apply(?:[\"'?/]|\b))"
MIN_HTML, THIN_TEXT, SHELL_TEXT = 500, 200, 2500
# Wording that tells what kind of site a home page belongs to.
PERSONAL = ("download resume", "professional summary", "linkedin profile", "my resume", "curriculum vitae", "personal website", "portfolio of work")
BUSINESS = ("customers", "platform", "solutions", "company", "careers", "contact sales", "privacy policy", "terms of service")
CONSUMER = ("add to cart", "restaurant", "view menu", "wedding photography", "dental practice", "for sale by owner")
LEGAL_TECH = ("legal ai", "legal technology", "platform", "solutions", "customers", "contact sales", "security", "careers")
PARKED = ("domain for sale", "parking page", "buy this domain")
# Evidence types, the page types they are read from, and their terms.
EVIDENCE = {
    "hiring_activity": (("careers",), ("open roles", "open positions", "current openings", "current job openings", "job openings", "job listing", "job listings", "vacancies", "browse our vacancies", "view current career opportunities", "recruiting process", "apply", "we're hiring", "greenhouse", "lever", "ashby", "workday", "jobvite", "bamboohr", "workable", "job alerts", "full-time", "full time", "part-time", "part time", "employment type", "remote", "on-site", "recruit", "採用", "募集要項", "応募方法", "職種", "待遇")),
    "it_ops_hiring": (("careers",), ("mdm", "device management", "endpoint management", "identity provider", "identity providers", "okta", "azure ad", "google workspace", "corporate it", "workplace technology", "systems administrator", "it administrator", "infrastructure engineer")),
    "funding_or_growth": (("news", "company"), ("raised", "funding", "financing", "investment", "series a", "series b", "series c", "series d", "growth equity")),
    "security_maturity": (("security", "company"), ("trust center", "soc 2", "iso 27001", "compliance", "gdpr", "hipaa", "security")),
    "procurement_or_renewal": (("procurement", "security", "company"), ("procurement", "rfp", "vendor", "supplier", "renewal", "vendor review")),
}
# The order in which boards are guessed, words a brand drops and labels in front of an apex.
BOARD_ORDER = ("greenhouse", "lever", "ashby", "smartrecruiters", "workable", "recruitee", "rippling", "pinpoint")
BRAND_PREFIXES = ("go", "get", "try", "use", "join", "hey", "team", "the", "with")
NON_APEX = ("www", "careers", "career", "jobs", "job", "apply", "app", "go", "get", "hire", "hiring", "talent", "work", "en", "us", "info", "boards", "about")
BOARD_URLS = {
    "greenhouse": "https://boards.greenhouse.io/%s", "lever": "https://jobs.lever.co/%s", "ashby": "https://jobs.ashbyhq.com/%s", "smartrecruiters": "https://jobs.smartrecruiters.com/%s",
    "workable": "https://apply.workable.com/%s", "recruitee": "https://%s.recruitee.com/", "pinpoint": "https://%s.pinpointhq.com/", "rippling": "https://ats.rippling.com/%s/jobs",
}
# Paths of listings one hop from a careers page, and first segments below careers that are no posting.
LISTING_PATH = r"(?i)(^|/)(jobs?|careers?/jobs?|jobs?-listings?|jobs?-postings?|jobs?-opportunities|open-positions?|open-roles?|current-openings?|vacancies|board)(/|$)"
DETAIL_PATH = r"(?i)(^|/)(careers?|jobs?)/[^/?#]{4,}"
NO_DETAIL_PATH = r"(?i)(^|/)(careers?|jobs?)/(culture|benefits?|life|values?|teams?|faq|internships?|students?|volunteers?|partnership|professional-development|privacy|impact|overview|employee-benefits?|student-program|events?|blog|news|leadership)/?$"
# Careers addresses in sitemaps and robots files; jobs tabs of social networks.
CAREERS_URL = r"(?i)https?://[^\s\"'<>]*?/(?:careers?|jobs?|hiring|join-?us|join-our-team|open-positions?|open-roles?|current-openings?|vacanc(?:y|ies)?|opportunities|employment|[a-z-]*job[_-]listing[a-z-]*)(?:[/?#][^\s\"'<>]*)?"
SOCIAL_JOBS = r"(?i)https?://(?:[a-z0-9-]+\.)?(?:linkedin\.com/company/[^/\s\"'<>]+/jobs|wellfound\.com/company/[^/\s\"'<>]+/jobs)"
# Keys under which embedded JSON names a board.
BOARD_TOKENS = {
    "greenhouse": r"(?i)\"(?:greenhouse[_-]?token|gh[_-]?token|board[_-]?token)\"\s*:\s*\"([A-Za-z0-9_-]{2,})\"",
    "lever": r"(?i)\"(?:lever[_-]?account(?:[_-]?name)?|lever[_-]?site)\"\s*:\s*\"([A-Za-z0-9_-]{2,})\"",
    "ashby": r"(?i)\"(?:ashby[_-]?(?:org|account|job[_-]?board[_-]?name))\"\s*:\s*\"([A-Za-z0-9_-]{2,})\"",
}
# Fixed values: (host, path) patterns of board addresses that are no boards; either may be empty.
UTILITY_URLS = (
    (r"^login\.", ""), (r"^admin\.aaimtrack\.com$", ""), (r"^(www\.)?(bamboohr\.com|workable\.com|breezy\.hr|paylocity\.com|pinpointhq\.com)$", ""), (r"^jobseekers\.workable\.com$", r"^/hc/"),
    (r"\.aaimtrack\.com$", r"/(?:account|help|stats|widget)/|applicant-communication-policy"), (r"\.icims\.com$", r"^(?!/jobs)"), (r"^jobs\.gem\.com$", r"^/gem/embed/*$"),
    (r"^recruiting\.paylocity\.com$", r"/recruiting/(?:publicleads|bundles)/|/recruiting/jobs/(?:jobnotfound|getlogo)"), (r"^recruiting.*\.ultipro\.com$", r"/(?:accessibility|account/register|authcode/postlogin)(?:/|$)"),
    (r"\.pinpointhq\.com$", r"/register-your-interest(?:/|$)"), (r"^(app\.|www\.)?rippling\.com$", r"^/legal/|^/products/hr/recruiting/?$|^/recruiting/?$"), ("", r"/share_image/|/jobalerts$|/llms\.txt$|privacy-policy|terms-of-service"),
    (r"jobvite\.com$", r"/apply$"), (r"^(apply|jobs)\.workable\.com$", r"^/(?:oops|login|error)(?:/|$)"), (r"\.teamtailor\.com$", r"/locations/map_details\b|^/api/|^/admin/"),
    (r"\.oraclecloud\.com$", r"/hcmui/(?:candidateexperience/sitemaps|candidateexperience/images|afr/blank)"),
)
# Terms that make a listing, details of employment, and wordings that open or close a role.
LISTING_TERMS = ("open roles", "open positions", "current openings", "current job openings", "job openings", "job listing", "job listings", "vacancies", "browse our vacancies", "view current career opportunities", "recruiting process", "greenhouse", "lever", "ashby", "workday", "jobvite", "bamboohr", "workable", "smartrecruiters", "採用", "募集要項", "応募方法", "職種", "待遇")
DETAIL_TERMS = ("full-time", "full time", "part-time", "part time", "employment type", "remote", "on-site")
NO_ROLES = r"(?i)\b(?:there are )?currently no (?:open roles?|open positions?|job openings?|positions?|vacancies)\b|\bno (?:open roles?|open positions?|job openings?|positions?|vacancies|jobs) (?:available|at this time)\b|come back later"
ROLE_CARD = r"(?is)\b(?:view job|apply for this job|apply for this role)\b|\bdepartment\b.{0,240}\b(?:remote|location|office)\b"
SAME_SITE_ROLE = r"(?is)(?:\b(?:back to all roles?|all roles?)\b.{0,1200}\b(?:team|department)\b.{0,400}\b(?:location|office)\b.{0,400}\bapply\b|\bdepartment\b.{0,500}\boffice\b.{0,500}\bapply\b)|\b[A-Z][A-Za-z0-9&/+',.() -]{3,90}\b.{0,500}\bapply for this role\b"
JOB_CONTEXT = ("open roles", "open positions", "current openings", "job openings", "job listings", "apply", "job", "role", "position", "responsibilities", "requirements", "qualifications", "nice-to-haves", "greenhouse", "lever", "ashby", "workday", "jobvite", "bamboohr", "smartrecruiters")
