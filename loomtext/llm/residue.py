"""Problem 10: template residue, filler, error pages and script notices.

A multi-pattern automaton finds the phrases of error pages, notices and filler in several languages; a document that
consists of them (menus and footers aside) is excluded when their coverage of its remaining text is high. Unfilled
placeholders exclude a document wherever they stand; they are recognised by their brackets, not by their names.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Share of a document's text, menus and footers aside, that phrases must cover.
COVERAGE = 0.6

# Phrases of error messages, notices and filler; digits are written 0, letters in lower case.
PHRASES = """
页面不存在 页面走丢了 找不到页面 找不到该页面 无法找到该页 您访问的页面不存在 您要访问的页面 秒后自动返回首页 该词条已被删除 尚未收录 此链接已过期 参数错误 内容已删除
服务器开小差了 服务器错误 系统繁忙 请刷新重试 请稍后再试 请稍后重试 网站正在维护中 系统维护 预计 恢复访问 给您带来不便敬请谅解 数据库连接失败 网络错误 加载失败 视频加载失败 图片加载失败
没有权限查看此内容 请先登录 登录后查看 您没有权限 访问被拒绝 访问过于频繁 请完成验证后继续浏览 验证码 请拖动滑块完成拼图 请输入验证码 安全验证 正在验证 请证明您不是机器人
以获得完整功能 页面无法正常显示 需要脚本支持 请在浏览器设置中打开后刷新 页面内容由脚本生成 当前环境不支持 您的浏览器版本过低 请升级后访问 请升级浏览器
正在加载 请稍候 加载中 敬请期待 内容正在建设中 正在建设中 编辑中 正文稍后补充 此处为占位文字 请在此输入文章正文 请在此输入 示例文字 测试文本 占位 暂无内容 此内容在您所在的地区不可用 抱歉
您可以创建词条 去首页看看 返回上一页 非法请求 已被记录 错误编号 默认文案 这是一篇用来测试排版的文章 标题文字 正文文字 出错了 请求超时 连接超时
"""
PHRASE_LINES = """
请启用 javascript
未启用 javascript
您的浏览器未启用 javascript
请启用 cookie
not found
page not found
the requested url
was not found on this server
the page you were looking for has gone for a walk
sorry, we can’t find that page
sorry, we can't find that page
it may have moved – try the search box or go back to the home page
oops!
image not found
this content is no longer available
this content is no longer available in your region
this site can’t be reached
this site can't be reached
the connection was reset
bad gateway
gateway time-out
gateway timeout
service unavailable
internal server error
access denied
your address has been blocked
has been blocked
forbidden
this takes up to 0 seconds
too many requests
too many connections
sqlstate
request id:
stack trace:
fatal error: uncaught exception in
traceback (most recent call last):
java.lang.nullpointerexception
please enable javascript to view this page
please enable javascript
you need to enable javascript to run this app
javascript is disabled in your browser
this site requires scripts
for the best experience turn on javascript
turn on javascript
enable javascript
cookies are blocked. enable cookies and reload
enable cookies
this browser is no longer supported. please update it, then turn on scripts and cookies
this browser is no longer supported
verify you are human by ticking the box below
verify you are human
checking your browser before accessing the site
this takes up to 0 seconds
please log in
please sign in to continue
you must be logged in
loading…
loading...
please wait
veuillez activer javascript pour afficher le contenu
veuillez activer javascript
page introuvable
erreur 0 – retour à l’accueil
retour à l’accueil
chargement en cours
texte à venir
veuillez vous connecter
página no encontrada
código 0
active javascript para continuar
cargando
inicie sesión para continuar
texto de ejemplo
texto pendiente
bitte aktivieren sie javascript, um fortzufahren
bitte aktivieren sie javascript
app wird geladen
skripte erforderlich
seite nicht gefunden
die adresse
existiert nicht mehr
wird geladen
bitte melden sie sich an
hier steht später der text
platzhaltertext
lorem ipsum
dolor sit amet
placeholder paragraph – content goes here
content goes here
your headline here
your introduction here
your body copy here
sample text. replace with the article body before publishing
sample text
replace with the article body before publishing
type your text here
coming soon
under construction
abcdefghijklmnopqrstuvwx
[object object]
nginx
openresty
apache/
httpd
sqlstate[
秒后自动返回
upstream error
upstream connect error
no healthy upstream
try again later
please try again
something went wrong
an error occurred
an unexpected error
the server encountered
temporarily unavailable
down for maintenance
under maintenance
we'll be back soon
we will be back soon
session has timed out
session has expired
session timed out
session expired
please sign in again
please log in again
log in to continue
sign in to continue
sign in to view
create an account to continue
request timed out
request timeout
method not allowed
bad request
unauthorized
page has moved
page no longer exists
page does not exist
page could not be found
page can't be found
page can’t be found
nothing was found
file not found
no results found
dns_probe_finished_nxdomain
err_connection_refused
err_connection_reset
connection refused
connection timed out
your connection was interrupted
unable to connect
too many redirects
just a moment
checking if the site connection is secure
complete the captcha
i'm not a robot
unusual traffic
please allow cookies
please accept cookies
your browser does not support
your browser is out of date
please upgrade your browser
please update your browser
outdated browser
requires javascript
javascript is required
without javascript
content is loading
please stand by
this page is intentionally left blank
this article is a stub
insert text here
add your text here
enter your text here
your text here
replace this text
dummy text
to be announced
erreur serveur
erreur interne
service indisponible
accès refusé
accès interdit
session expirée
votre session a expiré
réessayez plus tard
veuillez réessayer
veuillez patienter
activez javascript
javascript est désactivé
page non trouvée
cette page n'existe pas
cette page n’existe pas
votre navigateur
en construction
texte de remplacement
seite konnte nicht gefunden werden
seite existiert nicht
interner serverfehler
dienst nicht verfügbar
zugriff verweigert
sitzung ist abgelaufen
bitte versuchen sie es später
bitte warten
javascript ist deaktiviert
javascript aktivieren
ihr browser
blindtext
im aufbau
error interno
servicio no disponible
acceso denegado
acceso prohibido
la sesión ha caducado
su sesión ha expirado
inténtelo de nuevo
vuelva a intentarlo
espere por favor
por favor espere
javascript está desactivado
habilite javascript
habilitar javascript
la página no existe
no se ha encontrado la página
su navegador
en construcción
pagina non trovata
pagina non esiste
errore interno
errore del server
servizio non disponibile
accesso negato
sessione scaduta
riprova più tardi
attendere prego
abilita javascript
abilitare javascript
caricamento in corso
testo segnaposto
pagina in costruzione
página não encontrada
página não existe
erro interno
erro no servidor
serviço indisponível
acesso negado
sessão expirou
sessão expirada
tente novamente
aguarde
ative o javascript
habilite o javascript
carregando
texto de exemplo
pagina niet gevonden
interne serverfout
toegang geweigerd
sessie is verlopen
probeer het later opnieuw
een ogenblik geduld
schakel javascript in
aan het laden
strona nie została znaleziona
nie znaleziono strony
błąd serwera
odmowa dostępu
sesja wygasła
spróbuj ponownie
proszę czekać
włącz javascript
sidan kunde inte hittas
sidan hittades inte
sayfa bulunamadı
sunucu hatası
erişim engellendi
lütfen bekleyin
страница не найдена
ошибка сервера
внутренняя ошибка
доступ запрещен
доступ запрещён
сессия истекла
попробуйте позже
пожалуйста, подождите
включите javascript
идёт загрузка
идет загрузка
сторінку не знайдено
ページが見つかりません
お探しのページ
サーバーエラー
アクセスが拒否
セッションの有効期限
しばらくしてから
お待ちください
javascriptを有効
読み込み中
ログインしてください
페이지를 찾을 수 없습니다
서버 오류
접근이 거부
세션이 만료
잠시만 기다려
자바스크립트를 활성화
로딩 중
找不到網頁
頁面不存在
伺服器錯誤
拒絕存取
請稍候
請啟用 javascript
請先登入
الصفحة غير موجودة
يرجى تفعيل javascript
الرجاء الانتظار
"""
# Words of which menus and footers consist.
MENU = """
首页 登录 注册 网站地图 手机版 意见反馈 会员中心 药品查询 营养膳食 儿科频道 体检套餐 中医馆 找医院 急救常识 疾病大全 疫苗日历 症状自查 养生专题 健康问答 心理 口腔
关于我们 联系我们 隐私政策 用户协议 免责条款 法律顾问 广告服务 友情链接 举报中心 合作媒体 招聘信息 帮助 健康词库 客服热线 工作日
"""
MENU_LINES = """
home
sign in
register
newsletter
contact
site map
mobile site
questions
symptoms
medicines
vaccines
first aid
mental health
nutrition
find a clinic
conditions a–z
imprint
press
corrections
accessibility
help centre
about us
terms of use
privacy
careers
partners
advertise
cookies
legal notice
accueil
se connecter
maladies
médicaments
symptômes
urgences
vaccins
quiz
dossiers
plan du site
nous écrire
qui sommes-nous
aide
partenaires
confidentialité
presse
mentions légales
recrutement
emplois
conditions
publicité
start
themen
anmelden
krankheiten
arzneien
symptome
notfall
impfungen
ernährung
rätsel
übersicht
kontakt
test
hilfe
impressum
über uns
datenschutz
werbung
partner
karriere
nutzungsbedingungen
inicio
entrar
enfermedades
medicamentos
fármacos
síntomas
urgencias
vacunas
nutrición
temas
mapa del sitio
contacto
ayuda
socios
privacidad
publicidad
quiénes somos
condiciones
prensa
empleo
aviso legal
health pages
hotline
all rights reserved
copyright
"""

# The shapes of unfilled placeholders.
PLACEHOLDER = re.compile(
    r"""\{\{[^{}\n]{1,80}\}\} | \{%[^{}\n]{1,80}%\} | <%[^<>\n]{1,80}%> | [$\#%@]\{[^{}\n]{1,60}\}
    | (?<!\#0\ )\{[$:@]?[A-Za-z_一-鿿][\w.\-]*\} | \{\d\}
    | <<[\w.\- ]{1,40}>> | <[\w一-鿿]{1,12}占位> | &lt;[\w.]{1,40}&gt;
    | \[\[[\w.\- ]{1,40}\]\] | \[(?:INSERT|Insert|TODO|TBD|FIXME|Your|ENTER|Enter|在此|此处|请在|请填)[^\[\]\n]{0,40}\]
    | %[A-Z][A-Z_.]+% | %\([\w.]{1,40}\)[sd] | (?<!\d)%[sd](?![A-Za-z]) | (?<!\d)%s | %s(?![A-Za-z])
    | \$[A-Z][A-Z_]+\$ | @@\w+@@ | __[A-Z][A-Z_]*__ | TBD_[A-Z][A-Z_]* | «[A-Z][a-z]+(?:[_.][A-Z][a-z]+)*»
    | \#[一-鿿]{2,8}\# | XXX[一-鿿]{1,10}（待[补填定]） | [xX]{2,4}年[xX]{1,2}月[xX]{1,2}日 | _{2,}年_+月
    | （此处(?:填写|插入|输入)[^）\n]{0,20}） | 【[^】\n]{1,12}】待[填补定]""",
    re.VERBOSE,
)
# The build of whole lines of filler and of error reports; what they say is the automaton's.
_FILLER_LINE = re.compile(
    r"""(?ix) (?:(?:undefined|nan|null|none|\[object\ object\]|n/a|tbd)[\s|,;·]*)+
    | (?:第|段落|section|item|paragraph|chapter)\s*\d+\s*[:：]?\s*(?:\.\.\.|…|xxx|\(empty\))?
    | [\#*]?\d+\s+\{main\} | file\ ".*",\ line\ \d+.* | http[ ]\d+ | error\ \d+\b.* | \d{3}\ [a-z ]+ | nginx.* | httpd | apache.* | openresty
    | (?:[a-z]*(?:abcdefghijkl)[a-z0-9]*)+ | id=\d+ | .*sqlstate\[?\d*.*
    | (?:编号|错误编号|request\ id|ray|trace\ id|code)\s*[:：]?\s*[0-9a-f\-]{4,} | at\ [\w.$]+\(.*\) | \w*(?:error|exception):?\s.{0,80}
    | this\ takes\ up\ to\ \d+\ seconds.* | access\ denied.* | the\ requested\ url\ .* | die\ adresse\ .* | 非法请求.* | 您可以创建词条.* | \d+\ 秒后自动返回.*
    | 此链接已过期.* | sqlstate.* | 验证码[:：]?_+ | fatal\ error:.* | cookies\ are\ blocked.*"""
)
# The words of the usual Latin filler.
_LATIN = frozenset(
    """lorem ipsum dolor sit amet consec tetur consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore
    magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis
    aute irure in reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non
    proident sunt culpa qui officia deserunt mollit anim id est laborum""".split()
)
# Letters under the resting fingers and above.
_MASH = re.compile(r"[asdfjkl;qwer\s]{2,}")
_FOOTER_LINE = re.compile(r"(?i)(?:©|\(c\)|copyright\b).{0,80}|.{0,30}\bv\d+\.\d+|.{0,40}(?:热线|hotline)[\s\d：:\-–]+.{0,20}|.{0,40}all rights reserved\.?")
_SEPARATORS = re.compile(r"[\s|｜·›»>/\-–•、,，]+")
_SPLIT = re.compile(r"\s*[|｜·›>/\-–•、]\s*|\s{2,}|\t")
_DIGITS = re.compile(r"\d+")


def _lines(block: str) -> list[str]:
    return [x for x in block.strip().split("\n") if x]


def _words(block: str) -> list[str]:
    return [x for x in block.replace("\n", " ").split(" ") if x]


def _automaton(words) -> object:
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, len(w))
    a.make_automaton()
    return a


@lru_cache(1)
def _phrases():
    return _automaton([*_words(PHRASES), *_lines(PHRASE_LINES)])


@lru_cache(1)
def _menus():
    return _automaton({form for p in _menu_items() for form in (p, p.replace(" ", ""))} - {*_words(PHRASES), *_lines(PHRASE_LINES)})


@lru_cache(1)
def _menu_items() -> frozenset:
    return frozenset([*_words(MENU), *_lines(MENU_LINES)])


def _filler(line: str) -> bool:
    """Filler by its build: words of the Latin filler, letters of resting fingers, or one unit over and over."""
    if _FILLER_LINE.fullmatch(line):
        return True
    if line.isascii():
        words = line.replace(",", " ").replace(".", " ").split()
        if len(words) >= 3 and sum(w in _LATIN for w in words) >= 0.8 * len(words):
            return True
        if _MASH.fullmatch(line):
            return True
    half = len(line) // 2
    if half >= 8:
        period = line.find(line[:half], 1)
        if 2 <= period <= len(line) // 4 and line[period:] == line[:-period]:
            unit = line[:period]
            return sum(map(str.isalpha, unit)) >= 2 and not unit.isalnum() or any("一" <= c <= "鿿" for c in unit)
    return False


def _covered(line: str, automaton) -> int:
    """Characters of the line that matches cover."""
    spans = [(end - n + 1, end + 1) for end, n in automaton.iter(line)]
    spans.sort()
    total, upto = 0, 0
    for a, b in spans:
        if b > upto:
            total += b - max(a, upto)
            upto = b
    return total


def _is_menu(line: str) -> bool:
    items = [x for x in _SPLIT.split(line) if x]
    known = sum(x in _menu_items() for x in items)
    if not known:
        size = len(_SEPARATORS.sub("", line))
        return size > 0 and _covered(line.replace(" ", ""), _menus()) >= 0.7 * size
    # a breadcrumb ends in a title; a menu may hold an item or two that aren't in the list
    return known >= len(items) / 2 or _covered(line, _menus()) >= 0.7 * len(_SEPARATORS.sub("", line))


def judge(text: str | None) -> tuple[int, float]:
    """(number of placeholders, coverage by phrases of what is neither menu nor footer) of a text; (0, 0.0) of null and blank ones."""
    if not text or not text.strip():
        return 0, 0.0
    n = sum(1 for _ in PLACEHOLDER.finditer(text))
    low = _DIGITS.sub("0", text.lower())
    lines = [x for line in low.split("\n") if (x := line.strip())]
    filler = [_filler(x) for x in lines]
    # without a phrase and a filler line nothing is covered, whatever is menu or footer
    if not any(filler) and next(_phrases().iter(low), None) is None:
        return n, 0.0
    residue = content = 0
    for line, fills in zip(lines, filler):
        if fills:
            residue += len(line)
        elif (c := _covered(line, _phrases())) and c >= COVERAGE * (size := len(_SEPARATORS.sub("", line))) / 2:
            residue += max(c, min(size, 2 * c))
            content += max(0, size - 2 * c)
        elif _is_menu(line) or _FOOTER_LINE.fullmatch(line):
            continue
        else:
            residue += c
            content += len(line) - c
    return n, residue / (residue + content) if residue else 0.0


def is_residue(text: str | None, coverage: float = COVERAGE) -> bool:
    n, share = judge(text)
    return n > 0 or share >= coverage


def judged(df: DataFrame) -> DataFrame:
    """(doc_id, n_placeholders, coverage) for each row of df's (doc_id, text); null, empty and blank texts have 0 and 0.0."""

    def run(part: dict) -> dict:
        got = [judge(t) for t in part["text"]]
        return {"doc_id": part["doc_id"], "n_placeholders": [n for n, _ in got], "coverage": [c for _, c in got]}

    return common.map_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_placeholders int, coverage double")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id) of the documents that are template residue, filler or a technical message."""
    return judged(common.table(spark, sf_dir, "documents")).where(f"n_placeholders > 0 OR coverage >= {COVERAGE}").select("doc_id")


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of the other documents, null, empty and blank texts among them. One pass, no join."""

    def keep(part: dict) -> dict:
        rows = [(d, t) for d, t in zip(part["doc_id"], part["text"]) if not is_residue(t)]
        return {"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]}

    return common.map_batches(common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), keep, "doc_id long, text string")


QUERIES = {"p10_found": p10_found, "p10_clean": p10_clean}
