"""Labelled phrases of filler and of notices, from which the models of residue are fitted. They are made by rule: from the status codes
and error texts of the standard library, the public filler passage, and products of short word lists in four languages. No
phrase is copied from the data; README names what was added after a look at differences there. <n> is a number. Their number is fixed, so that the labelled sample is bounded."""

from __future__ import annotations

import builtins
import errno
import os
from hashlib import blake2b
from http import HTTPStatus
from itertools import product

_EN = ("title", "abstract", "summary", "author", "authors", "publisher", "department", "version", "condition", "topic", "name", "date", "institution", "subtitle", "keywords", "text", "description", "year", "disease", "population", "guideline", "content", "heading")
_SNAKE = (*_EN, "doc_title", "document_title", "short_title", "guideline_name", "publication_date", "article.title", "page.title", "abstract_text", "author_name", "org_name", "field", "value", "placeholder", "variable")
_DE, _FR = ("titel", "text", "zusammenfassung", "name", "datum", "überschrift", "krankheit", "fachgebiet"), ("titre", "texte", "résumé", "nom", "date", "sous-titre", "maladie", "service")
_ZH = ("标题", "摘要", "文本", "名称", "日期", "内容", "疾病名称", "科室", "作者", "年份")
#: What forms put around the name of a field.
_AROUND = (("{{", "}}"), ("{{ ", " }}"), ("${", "}"), ("#{", "}"), ("<%= ", " %>"), ("{% ", " %}"), ("<", ">"), ("<<", ">>"), ("[", "]"), ("[[", "]]"), ("{", "}"), ("%", "%"), ("@@", "@@"), ("__", "__"), ("«", "»"), ("&lt;", "&gt;"), ("%(", ")s"), ("$", "$"), ("|", "|"))

#: The public passage of filler text, sentence by sentence.
_PASSAGE = (
    "lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.", "ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.",
    "duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.", "excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
    "the quick brown fox jumps over the lazy dog", "franz jagt im komplett verwahrlosten taxi quer durch bayern", "portez ce vieux whisky au juge blond qui fume",
)


def _all(*parts: tuple[str, ...] | str) -> list[str]:
    """Every choice of one phrase of each part, joined by blanks, or as they are for Chinese."""
    out = [x for x in product(*[(p,) if isinstance(p, str) else p for p in parts])]
    return ["".join(x) if any("一" <= c <= "鿿" for c in "".join(x)) else " ".join(filter(None, x)) for x in out]


def filler() -> list[str]:
    return [
        *_PASSAGE, *_PASSAGE,
        *[f"{a}{f}{b}" for f, (a, b) in product(_SNAKE, _AROUND)], *[f"{a}{f} | {g}{b}" for f, (a, b), g in product(_SNAKE[:8], _AROUND[:2], ("upper", "title", "safe"))], *[f"{a}{f}{b}" for f, (a, b) in product(_ZH + _DE + _FR, (("[", "]"), ("【", "】"), ("〔", "〕"), ("<", ">"), ("{{", "}}"), ("{", "}")))],
        *_all(("sample", "dummy", "placeholder", "example", "test", "default", "temporary"), (*_EN, "document")), *_all(("sample", "dummy", "placeholder", "example"), _EN[:12], ("text", "text here", "here")), *_all(_EN, ("goes here", "here", "tbd", "tbc", "tba", "n/a", "to be added", "to be determined", "to be confirmed", "to be supplied", "to follow", "pending", "coming soon", "not available", "missing")),
        *_all(("[insert", "[enter", "[add", "[type", "[your", "<insert", "<enter", "<your", "(insert", "insert", "enter", "add", "click to add", "click here to enter", "please enter", "please add", "todo: add", "fixme:", "todo: insert"), ("", "the", "a"), _EN[:12], ("", "here", "here]", ">", "]")),
        *_all("your", _EN, ("here", "goes here")), *_all(("untitled", "new", "blank", "empty"), ("", "document", "page", "file", "record", "document <n>", "(<n>)", "-<n>", "document (<n>)")), *_all("no", _EN[:8], ("", "available", "provided", "entered", "given")),
        *_all(("this is", "this text is", "just"), ("a placeholder", "placeholder text", "dummy text", "filler text", "sample text"), ("", "and must be replaced", "only", "- do not publish")), *_all(("replace", "remove", "delete"), ("this text", "this", "me"), ("", "before publication", "before publishing", "with real content")), "do not publish", "draft - do not cite", "to be determined", "tbd", "tbc", "tba", "todo", "fixme", "n/a", "none", "null", "undefined", "nan",
        *_all(_DE, ("hier eingeben", "hier einsetzen", "einfügen", "eingeben", "folgt", "ergänzen", "fehlt", "bitte ersetzen", "bitte ausfüllen")), *_all("hier", ("steht", "folgt", "den", "die", "das", ""), _DE, ("", "eingeben", "einfügen", "eintragen")), "platzhalter", "platzhaltertext", "blindtext", "mustertext", "beispieltext", "beispieltitel", "fülltext", "ohne titel", "unbenannt", "unbenanntes dokument", "neues dokument (<n>)", "kein titel vorhanden", "bitte ersetzen", "vor veröffentlichung ersetzen",
        *_all(("insérer", "saisir", "ajouter", "compléter", "indiquer", "entrer"), ("", "le", "la", "votre"), _FR, ("", "ici")), *_all(_FR, ("à compléter", "à remplacer", "à définir", "à insérer", "à venir", "ici", "manquant")), "texte de remplissage", "texte d'exemple", "faux texte", "exemple de titre", "sans titre", "sans titre <n>", "document sans titre", "nouveau document (<n>)", "à compléter", "à remplacer avant publication",
        *_all(("此处", "在此", "这里", "请在此处", "请"), ("填写", "输入", "插入", "添加"), _ZH), *_all(("示例", "占位", "测试", "样例", "默认", "模板", "虚拟"), (*_ZH, "文字", "标题<n>", "文本<n>")), *_all(("待", "待定", "暂无", "无", "未填写", "请替换", "请补充"), ("", *_ZH)), *_all("这里是", _ZH, ("", "示例", "占位"), ("文字", "内容"), ("", "，请替换。")), "待补充", "待填写", "待定", "未命名", "未命名文档", "无标题", "无标题文档", "新建文档<n>", "占位文本占位文本", "发布前请删除", "请替换",
        *[x for x in ("xxx", "xxxx", "xx", "xxxxx xxxxx", "xxx xxx xxx", "xx病", "xx病诊疗指南", "xxxx年", "xxxx年版", "（xxxx年版）", "xx指南", "aaa", "aaa bbb ccc", "abc abc", "asdf", "asdf asdf", "asdfgh", "asdf jkl", "qwerty", "qwertz", "qwerty qwerty", "test", "test test", "test test test", "testing <n>", "foo bar", "foo bar baz", "hello world", "blah blah blah") for _ in range(2)],
    ]


_ON, _OFF = ("enable", "allow", "activate", "turn on", "switch on", "enabling", "turning on"), ("disabled", "turned off", "switched off", "required", "not supported", "not enabled", "blocked", "needed")
_WHAT = ("javascript", "scripts", "cookies", "script support", "client-side scripts", "javascript and cookies", "scripting", "js")
_WHY = ("", "in your browser", "in your browser settings", "to continue", "to view this page", "to use this site", "to run this app", "and reload the page", "and try again", "to see this content", "first")
_SORRY = ("", "sorry,", "we're sorry,", "oops!", "error:")
_WRONG = ("something went wrong", "an error occurred", "an error has occurred", "an unexpected error occurred", "the page you requested could not be found", "that page can't be found", "the page you are looking for has been moved or deleted", "this page isn't working", "this page can't be displayed", "the requested resource is not available", "the server encountered an error", "your request could not be processed", "your request was blocked", "access denied", "you don't have permission to access this page", "you are not authorized to view this page", "the link has expired", "your session has expired", "session expired", "this content is no longer available", "the service is temporarily unavailable", "the site is under maintenance", "your access has been limited", "rate limit exceeded", "request timed out", "the connection was reset", "the file could not be loaded", "loading failed", "mysql server has gone away", "connection lost", "out of memory", "disk quota exceeded")
_THEN = ("", "please try again later", "please log in again", "please log in to continue", "please contact the administrator", "please reload the page", "contact support")
_ROBOT = ("checking your browser before accessing the site", "checking your browser before you continue", "please wait while we check your browser", "verify you are human", "please verify that you are a human", "are you a robot?", "i'm not a robot", "complete the captcha to continue", "please complete the security check to continue", "complete the action below to continue", "one moment please", "just a moment", "please stand by", "ddos protection", "unusual traffic from your network", "loading", "please wait")


def notices() -> list[str]:
    status = [(s.value, s.phrase.lower(), s.description.lower()) for s in HTTPStatus if s.value >= 400]
    return [
        *[x for n, p, d in status for x in (f"{n} {p}", f"error {n}", f"error {n}: {p}", f"http {n}: {p}", f"http error {n} - {p}", f"{p} ({n})", f"{p}", f"{p}. {d}.", f"{n} - {p} {d}", f"status {n}", f"错误 {n}：{p}", f"fehler {n}: {p}", f"erreur {n} : {p}", f"{p} [code {n}]", f"error code {n} - {p}")],
        *["error <n>", "error code <n>", "code <n>", "错误代码<n>", "（错误代码<n>）", "错误 <n>", "fehler <n>", "erreur <n>", "http <n>", "<n> <n> error", "errno <n>", "status <n>."],
        *[os.strerror(e).lower() for e in sorted(errno.errorcode)], *[f"error: {os.strerror(e).lower()}" for e in sorted(errno.errorcode)[:60]],
        *[x for n in sorted(dir(builtins)) if n.endswith(("Error", "Exception")) for x in (f"{n.lower()}: ", f"traceback (most recent call last): {n.lower()}")], *[x for f in _SNAKE for x in (f"keyerror: '{f}'", f"undefined index: {f}", f"undefined variable: {f}", f"cannot read property '{f}' of undefined", f"cannot read properties of null (reading '{f}')", f"uncaught typeerror: {f} is not a function", f"nullpointerexception at {f} line <n>", f"missing required field: {f}", f"syntax error near {f}")], "java.lang.nullpointerexception", "fatal error: uncaught exception", "segmentation fault", "stack trace", "warning: undefined array key", "exception in thread main", "at line <n>", "sql syntax error near",
        *_all(("", "please", "to continue, please", "you need to", "you must", "to continue,"), _ON, _WHAT, _WHY), *_all(_WHAT, ("is", "are", "must be", "has been"), _OFF, ("", "in your browser", "to view this page", "for this site", "to display this content")), *_all(("this site", "this page", "this app", "this application", "this document viewer", "this content"), ("requires", "needs", "works only with"), _WHAT, ("", "to work", "to be enabled")),
        *_all("your browser", ("has", "does not support", "doesn't support", "has blocked", "must support"), _WHAT, ("", "disabled", "switched off", "turned off")), *_all(("content hidden", "content blocked", "text not shown", "page blocked"), ("until", "because", "unless", ":"), _ON[:5], _WHAT[:5]),
        *_all(_SORRY, _WRONG, _THEN), *_ROBOT, *_ROBOT, *_all(_ROBOT[:9], _THEN), "page not found", "page not found | home", "back to home page", "go back", "please log in to view this content", "log in to continue", "subscribe to read the full text",
        *_all(("bitte", "sie müssen", "zum fortfahren bitte"), ("aktivieren sie", "erlauben sie", "schalten sie"), ("javascript", "cookies", "skripte"), ("", "ein", "in ihrem browser", "um fortzufahren", ", um fortzufahren", "um diese seite anzuzeigen")), *_all(("seite nicht gefunden", "zugriff verweigert", "interner serverfehler", "ihre sitzung ist abgelaufen", "sitzung abgelaufen", "ein fehler ist aufgetreten", "die angeforderte seite existiert nicht", "dienst nicht verfügbar", "zeitüberschreitung der anfrage", "javascript ist deaktiviert"), ("", "(fehler <n>)", "– bitte später erneut versuchen", "bitte melden sie sich erneut an", "bitte versuchen sie es später erneut")),
        *_all(("veuillez", "vous devez", "merci d'"), ("activer", "autoriser"), ("javascript", "les cookies", "les scripts"), ("", "dans votre navigateur", "pour continuer", "pour afficher ce contenu", "pour afficher cette page")), *_all(("page introuvable", "page non trouvée", "accès refusé", "accès interdit", "erreur interne du serveur", "votre session a expiré", "session expirée", "une erreur est survenue", "une erreur s'est produite", "service indisponible", "délai d'attente dépassé", "javascript est désactivé"), ("", "(erreur <n>)", ": veuillez réessayer plus tard", "veuillez vous reconnecter", "veuillez réessayer plus tard")),
        *_all(("请", "请先", "您需要", "需要", "必须", "为继续访问，请", "若要继续，请"), ("启用", "开启", "打开", "允许", "允许运行"), ("javascript", "脚本", "浏览器脚本", "cookies", "脚本功能", "浏览器的脚本功能"), ("", "后继续", "以继续", "后刷新页面", "后再访问", "以查看本页", "才能查看内容", "后查看全文")), *_all(("您的浏览器", "浏览器", "当前浏览器"), ("已禁用", "不支持", "未启用", "禁用了", "已关闭"), ("脚本", "javascript", "cookies"), ("", "，无法显示内容", "，请更换浏览器")),
        *_all(("抱歉，", "很抱歉，", ""), ("您访问的页面不存在", "您访问的页面出错了", "页面不存在", "页面无法显示", "无法显示此页面", "页面已被删除", "页面加载失败", "服务器内部错误", "服务器错误", "服务暂时不可用", "访问被拒绝", "禁止访问", "无权访问", "登录已过期", "会话已过期", "请求超时", "请求过于频繁", "链接已失效", "系统繁忙", "网络错误", "发生未知错误", "访问受限"), ("", "，请稍后重试", "，请稍后再试", "，请重新登录", "，请联系管理员", "（错误代码<n>）", "或已被删除")), *_all(("请完成", "请通过", "请先完成"), ("安全验证", "人机验证", "验证码"), ("", "后继续", "后继续访问", "以继续访问")), *_all(("正在", "系统正在"), ("检查您的浏览器", "验证您的浏览器", "加载", "跳转"), ("", "，请稍候", "…")),
    ]


def notes() -> list[str]:
    """Prose in brackets: what editors add to titles and sentences."""
    words = ("sic", "updated", "revised", "corrected", "corrected version", "retracted", "withdrawn", "republished", "archived", "superseded", "in press", "online", "letter", "editorial", "review", "erratum", "comment", "see comments", "proceedings", "authors' transl", "article in german", "article in french", "article in chinese", "in process", "reprint", "n = <n>", "<n>", "<n>-<n>", "<n>, <n>", "p < <n>", "<n>% ci", "aktualisiert", "überarbeitet", "zurückgezogen", "mis à jour", "révisé", "rétracté", "更新版", "修订版", "已撤回", "更正")
    return [f"{a}{w}{b}" for w, (a, b) in product(words, (("[", "]"), ("(", ")"), ("（", "）"), ("【", "】"), ("<", ">"), ("{", "}")))]


def halves(phrases: list[str]) -> tuple[list[str], list[str]]:
    """Two halves by a digest, to fit on one and to measure on the other."""
    out: tuple[list[str], list[str]] = ([], [])
    for p in dict.fromkeys(phrases):
        out[blake2b(p.encode(), digest_size=1).digest()[0] & 1].append(p)
    return out
