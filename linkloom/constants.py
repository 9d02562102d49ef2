"""Fixed values that results depend on: word lists, patterns and formats, in natural order."""

from __future__ import annotations

# ---- hosts and paths ----

BLOCKED_DOMAINS = ("youtube.com", "youtu.be", "youtube-nocookie.com", "googlevideo.com", "doubleclick.net", "googleadservices.com")
NON_MEDIA_EXTS = (
    "exe", "msi", "dll", "msix", "appx", "apk", "appimage", "deb", "rpm", "dmg", "pkg", "cab",
    "zip", "rar", "7z", "gz", "tgz", "bz2", "xz", "tar", "zst", "iso", "img", "bin",
    "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "epub", "rtf",
    "jpg", "jpeg", "png", "gif", "webp", "bmp", "svg", "ico", "tif", "tiff",
    "ttf", "otf", "woff", "woff2", "eot",
)
RAW_FILE_HOSTS = ("raw.githubusercontent.com", "gist.githubusercontent.com", "objects.githubusercontent.com")
FORGE_HOSTS = ("github.com", "gitlab.com", "bitbucket.org", "codeberg.org")
DIRECT_HINTS = (
    ".m3u8", ".m3u", ".mpd", ".flv", "/live/", "/hls/", "/stream/", "get.php", "player_api", "xmltv.php", "output=m3u8", "output=ts",
    "playlist.m3u8", "index.m3u8", "manifest.mpd", "?token=", "auth_username", "auth_password", "device_mac", "panel_api", "stalker_portal", "portal.php",
)
PLAYER_WORDS = (
    "watch", "live", "stream", "streams", "player", "players", "channel", "channels", "play", "tv", "iptv", "playlist", "playlists",
    "broadcast", "hls", "embed", "video", "videos", "show", "shows", "episode", "episodes", "movie", "movies",
)
LIST_HOSTS = (
    "gist.github.com", "gist.githubusercontent.com", "pastebin.com", "rentry.co", "paste.ee", "termbin.com",
    "hastebin.com", "dpaste.org", "dpaste.com", "justpaste.it", "pasteio.com", "codepen.io",
)
CREDENTIAL_PARAMS = r"token|auth_key|authkey|key|sign|sig|signature|hmac|password|passwd|pwd|pass|username|user|login|session(?:_id|id)?|sid|api_key|apikey|access_token|secret"
PLACEHOLDER_VALUES = (
    "test", "demo", "sample", "example", "xxx", "abc", "changeme", "default", "password", "pass", "qwerty", "guest", "null", "none",
    "undefined", "foobar", "foo", "bar", "temp", "tmp", "user",
)
PLACEHOLDER_STEMS = "test|demo|abc|xxx|user|pass|temp|tmp|sample|example"
ACCOUNT_PARAMS = ("username", "user", "login", "password", "passwd", "pwd", "pass", "session", "session_id", "sid")
ENGINE_HOSTS = (
    "bing.com", "duckduckgo.com", "brave.com", "google.com", "yahoo.com", "startpage.com", "mojeek.com", "wikipedia.org", "grokipedia.com",
    "yandex.com", "ecosia.org", "qwant.com", "searx.be", "searxng", "go.microsoft.com", "spredbird.com", "microsoft.com", "msn.com",
)
PLAYER_PAGE_FILES = ("m3u", "m3u8", "mpd", "mp4", "ts", "txt", "json")
LIVE_PATH_HINTS = ("live", "watch", "stream", "channel", "playlist", "m3u", "program", "now-playing", "epg", "tv")
SOURCE_PATTERNS = (
    ("iptv-org", r"iptv-org|iptv\.org"), ("yupptv", "yupptv|yuppcdn|yupplive"), ("pishow", r"pishow\.tv"), ("tangotv", r"tangotv\.in"),
    ("cloudfront", r"cloudfront\.net"), ("akamai", "akamai"), ("b4u", "b4u"), ("github", r"github\.com|githubusercontent"),
    ("smartplaytv", "smartplaytv"), ("playontv", "playontv"), ("wiseplayout", "wiseplayout"), ("sonyliv", r"sonyliv|sony\s*liv"),
    ("rajtv", r"rajtv\.tv"), ("amagi", "amagi"), ("tarangplus", "tarangplus"), ("olidigital", "olidigital"), ("live-streams", "live[-_]?streams?"),
)
GENERIC_LABELS = ("com", "net", "org", "tv", "in", "io")

# ---- links in text ----

URL_SCHEMES = ("https?", "rtsp", "rtmps?", "srt", "udp", "rtp", "p2p", "acestream", "webrtc", "wss?", "mms", "rist")
STREAM_SCHEMES = ("rtsp://", "rtmp://", "rtmps://", "srt://", "udp://", "rtp://", "p2p://", "acestream://", "webrtc://", "ws://", "wss://", "mms://", "rist://")
STREAM_HINTS = (
    ".m3u", ".m3u8", ".m3u_plus", ".txt", ".json", ".xml", ".asx", ".pls", ".xspf", ".tv", ".bqt", ".conf",
    ".ts", ".mpd", ".mp4", ".fmp4", ".flv", ".m4v", ".mkv", ".avi", ".mov", ".wmv", ".3gp", ".asf", ".manifest", "/manifest", "ism/manifest",
    "/get.php", "player_api.php", "xmltv.php", "/c/", "/portal.php", "stalker_portal", "panel_api", "enigma22_script", "manifest.mpd",
    "playlist.m3u8", "index.m3u8", "/stream/", "output=m3u8", "output=ts", "auth_username", "auth_password", "device_mac", "?token=",
)
GENERIC_EXTS = (".txt", ".json", ".xml", ".tv", ".bqt", ".conf")
STREAM_CONTEXT = r"m3u|playlist|stream|live|iptv|channel|get\.php|player_api|xtream|manifest|hls|/tv/|bouquet|enigma"
CHALLENGE_MARKERS = (
    "just a moment", "checking your browser", "/cdn-cgi/challenge-platform", "challenges.cloudflare.com", "cf-chl", "_cf_chl",
    "turnstile", "g-recaptcha", "hcaptcha.com", "attention required", "please enable cookies", "enable javascript and cookies",
)

# ---- names ----

QUALITY_TOKENS = ("", "hd", "fhd", "sd", "uhd", "4k", "p", "i")
SAFE_EXTRAS = (
    "hd", "fhd", "sd", "uhd", "4k", "hls", "live", "online", "hi", "hindi", "india", "in", "tv", "1", "2", "3", "4", "5", "sd1", "hd1", "fhd1",
    "sdhd", "mux", "hevc", "h264", "h265", "aac", "ac3", "multi", "dual", "audio", "sub", "subs", "clean", "raw", "backup", "alt", "main",
    "entertainment", "news", "sports", "music", "movies", "cinema", "prime", "plus", "max", "pro", "ultra", "super", "world", "national", "regional",
    "1080p", "720p", "576p", "540p", "480p", "360p", "240p", "2160p", "1080i", "720i", "576i", "480i", "1440p",
    "geo-blocked", "geoblocked", "geo", "blocked", "offline", "unavailable", "multi-audio", "dual-audio", "enhanced", "extended", "simulcast",
)
STRICT_QUALITY = (
    "hd", "fhd", "sd", "uhd", "4k", "hdr", "hlg", "hq", "fps", "h264", "h265", "hevc", "aac", "ac3", "dolby", "vision",
    "dual", "multi", "audio", "50fps", "60fps",
)
URL_DROP = ("hd", "fhd", "sd", "uhd", "4k", "p", "i", "tv")
URL_STOP = (
    "http", "https", "www", "com", "net", "org", "io", "tv", "in", "m3u8", "m3u", "index", "master", "playlist", "live", "origin",
    "ott", "smil", "cdn", "stream", "streams", "video", "videos", "hls", "output", "channel", "channels", "media", "assets",
    "app", "apps", "play", "player", "path", "file", "files",
)
SLUG_STOP = (*URL_STOP, "out", "v1", "linear", "event", "fta", "pub", "abr")
URL_SUFFIXES = ("hd", "fhd", "sd", "uhd", "4k", "1080p", "720p", "live", "online", "stream", "hls", "hi", "in", "india", "tv", "1", "2", "3", "4", "5")
QUALITY_RANK = {"2160p": 5, "1440p": 4, "1080p": 4, "720p": 3, "576p": 2, "540p": 2, "480p": 1, "360p": 1, "240p": 0}
QUALITY_POINTS = {"2160p": 20, "1440p": 20, "1080p": 20, "720p": 14, "576p": 10, "540p": 10, "480p": 7, "360p": 4}
BANDWIDTH_QUALITY = ((6_000_000, "1080p"), (3_500_000, "720p"), (1_800_000, "576p"), (1_000_000, "480p"), (1, "360p"))
CATEGORY_RULES = (
    ("News", ("news", r"aaj\s*tak", "ndtv", "republic", r"times\s*now", "abp", "news18")),
    ("Sports", ("sports", r"star\s*sports", r"sony\s*tens?", "ipl", "cricket")),
    ("Movies", ("movies?", "cinema", r"zee\s*cinema", r"sony\s*pix", r"star\s*gold")),
    ("Kids", ("kids", "cartoon", "pogo", "disney", "hungama")),
    ("Music", ("music", "mtv", "zoom", "9xm")),
    ("Religious", ("religious", "devotion", "aastha", r"god\s*tv", "temple")),
    ("Entertainment", ("entertainment", r"star\s*plus", r"sony\s*tv", r"zee\s*tv", "colors")),
)
NSFW_NAME = r"(?i)(?<![a-z0-9])(?:xxx|porn|nsfw|nude|hentai|erotic|sex)(?![a-z0-9])|(?<![a-z0-9])18\+(?![a-z0-9])|(?<![a-z0-9])blue[\s-]*film(?![a-z0-9])"
NON_LIVE = (
    r"(?i)(?<![a-z0-9])(?:promo|trailer|teaser|sample|preview|behind[-_]?the[-_]?scenes|episode|full[-_]?show|highlights?|recap|vod|vhs|clip|s\d{1,2}e\d{1,3}|"
    r"test|xxx|porn|nsfw|adult|nude|hentai|erotic|18\+|not\s*24\s*/?\s*7)(?![a-z0-9])|(?<![a-z0-9])ep\d{1,4}(?![a-z0-9])|"
    r"\.(?:png|jpe?g|gif|webp|svg|ico|bmp|mp4|mkv|avi|mov)(?:\?|$)"
)
NON_LIVE_PATH = r"(?i)/videos?/|/nickjr/|/nickjr\b|/vod/|/assets/videos/"
GEO_BLOCKED = r"(?i)geo[\s_-]*blocked"
FOREIGN_NAME = (
    r"(?i)(?<![a-z])(?:russia(?:n)?|paraguay|korea|italy|italian|german(?:y)?|czech|france|french|poland|polish|latin(?:\s+america)?|america(?:n)?s?|"
    r"united\s+states|united\s+kingdom|us(?:a)?|uk|canada|australia|europe|turkey|turkish|turkiye|azerbaijan|japan|hong[\s-]*kong|china|chinese|"
    r"singapore|malaysia|vietnam|indonesia|thailand|philip(?:pines)?|nigeria|ghana|kenya|africa|spain|spanish|portugal|netherlands|"
    r"dutch|belgium|sweden|norway|denmark|finland|greece|israel|lebanon|saudi|qatar|kuwait|oman|bahrain|uae|dubai|emirates|"
    r"egypt|morocco|pakistan|bangladesh|nepal|sri[\s-]*lanka|afghan|arabic|taiwan|bronx|brooklyn|manhattan|latino|"
    r"mexico|croatia|colombia|estonia|hungary|romania|serbia|bulgaria|slovakia|slovenia|ukraine|argentina|brazil|chile|peru|ecuador|"
    r"venezuela|bolivia|guadeloupe|sierra\s+leone|asia|ca|de|fr|gb|it|eu)(?![a-z])"
)
BRAND_NAMES = (
    r"(?i)\b(?:Star\s*(?:Plus|Sports|Gold|UTV|Maa|Jalsha|Pravah|Suvarna|Vijay|Bharat|One|Movies|Champions)|"
    r"Sony\s*(?:TV|SAB|SET|Ten|PIX|SIX|MAX|YAY|Marathi|Pal|Liv|Sports|BBC)|Zee\s*\w+|Colors?(?:\s+\w+)?|MTV\s*(?:India|Indies)|"
    r"DD(?:\s+\w+)?|Doordarshan|NDTV\s*\w*|News18\s*\w*|ABP\b(?:\s+\w+)?|TV9\s*\w*|Sun\s*(?:TV|Music|News)|Jaya\s+TV|"
    r"Hindi|Tamil|Telugu|Malayalam|Kannada|Bengali|Marathi|Gujarati|Punjabi|Odia|Bhojpuri|Assamese|Urdu|Rajasthani|Haryanvi|IPL|BCCI|India|Desi|Bollywood)\b"
)
#: Phrases that must not start inside a word, and single short words that must stand alone.
BRAND_PHRASES = (
    "star plus", "star sports", "star gold", "star utv", "star maa", "star jalsha", "star pravah", "star suvarna", "star vijay", "star bharat",
    "sony tv", "sony sab", "sony ten", "sony pix", "sony six", "sony max", "sony yay", "sony marathi", "sony pal",
    "zee tv", "zee cinema", "zee news", "zee business", "zee marathi", "zee tamil", "zee telugu", "zee kannada", "zee bengali", "zee punjabi",
    "zee anmol", "zee world", "zee bangla", "zee keralam", "colors bangla", "colors marathi", "colors kannada", "colors infinity",
    "mtv india", "and tv", "rishtey", "dd national", "dd news", "dd sports", "dd kisan", "dd bharti", "dd india", "doordarshan",
    "ndtv 24x7", "ndtv india", "ndtv profit", "times now", "republic bharat", "aaj tak", "india today", "india tv", "news18 india", "abp news",
    "abp ananda", "sun tv", "sun music", "sun news", "jaya tv", "k tv", "malayalam", "kannada", "bengali", "marathi", "gujarati", "punjabi",
    "bhojpuri", "assamese", "rajasthani", "haryanvi", "maithili", "bollywood", "jio cinema", "jio tv", "hotstar", "disney hotstar",
    "sony liv", "sonyliv", "mx player", "aha video", "eros now", "hungama", "shemaroo", "thop tv", "pikashow",
)
BRAND_WORDS = ("colors", "andtv", "&tv", "ndtv", "news18", "tv9", "hindi", "tamil", "telugu", "odia", "urdu", "tulu", "dogri", "ipl", "bcci", "india", "desi", "zee5", "voot")
REPUBLIC_TV = r"(?i)(?<![a-z]\s)\brepublic\s+tv\b"

# ---- languages and categories of lists ----

ISO_LANGUAGE = {
    "hin": "Hindi", "tam": "Tamil", "tel": "Telugu", "mal": "Malayalam", "kan": "Kannada", "ben": "Bengali", "mar": "Marathi", "guj": "Gujarati",
    "pan": "Punjabi", "ori": "Odia", "ory": "Odia", "urd": "Urdu", "bod": "Bhojpuri", "bho": "Bhojpuri", "asm": "Assamese", "kok": "Konkani",
    "mai": "Maithili", "sat": "Santali", "mni": "Manipuri", "doi": "Dogri", "nep": "Nepali", "ks": "Kashmiri", "sd": "Sindhi", "si": "Sinhala",
    "eng": "English",
}
LIST_LANGUAGES = (
    "Hindi", "Tamil", "Telugu", "Malayalam", "Kannada", "Bengali", "Marathi", "Gujarati", "Punjabi", "Odia", "Bhojpuri", "Assamese", "Urdu",
    "English", "Konkani", "Maithili", "Santali", "Manipuri", "Dogri", "Nepali",
)
PIPELINE_LANGUAGES = (
    "Hindi", "Tamil", "Telugu", "Malayalam", "Kannada", "Bengali", "Marathi", "Punjabi", "Gujarati", "Odia", "Urdu", "Bhojpuri",
    "Konkani", "Assamese", "English",
)
SCHEDULED_LANGUAGES = (
    "Assamese", "Bengali", "Bodo", "Dogri", "Gujarati", "Hindi", "Kannada", "Kashmiri", "Konkani", "Maithili", "Malayalam", "Manipuri",
    "Marathi", "Nepali", "Odia", "Punjabi", "Sanskrit", "Santhali", "Sindhi", "Tamil", "Telugu", "Urdu", "Bhojpuri",
)
LANGUAGE_ALIASES = {"oriya": "Odia", "odia": "Odia", "bojpuri": "Bhojpuri", "bhojpuri": "Bhojpuri", "gujrati": "Gujarati", "gujarati": "Gujarati", "assameese": "Assamese"}
NO_LANGUAGE = ("na", "n/a", "other", "-", "none")
LIST_CATEGORIES = {"news and current affairs": "News", "non- news and current affairs": "Entertainment", "non-news and current affairs": "Entertainment"}

# ---- formats ----

M3U_HEADER = '#EXTM3U xmlns:tvg="http://www.xmltv.org/" xmlns:m3u="http://www.xns schemas.com/2008/playlist"'
GONE_NOTES = ("http404", "http410", "non_media_ext", "blocked", "playlist_serves_file")
QUERY_SUFFIXES = (" m3u8", " m3u playlist", " iptv", " stream", " filetype:m3u", " github")
