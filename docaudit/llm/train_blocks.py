"""Trains the weights of the block labeller: ``python -m docaudit.llm.train_blocks PAGES.parquet [OUT.npz]``.

No page comes with labels. A teacher marks the lines that name themselves (consent, legal,
navigation, sharing, the ends of teasers) and the teasers between such lines; what it cannot
tell is not learnt from. So that the labeller also learns where a block of teasers within an
article ends, pages are put together from the parts of real ones: article lines, and whole
blocks of furniture taken from the ends of pages, where their extent is known.
"""

from __future__ import annotations

import random
import re
import sys

import numpy as np

from docaudit.llm.blocks import BUCKETS, HIDDEN, TEASER_END, WEIGHTS, WIDTH, BlockLabeller, block_features, sigmoid

#: Entries of navigation, by language (fixed values).
NAVIGATION = """
institutional investors|home|log in|menu|market views|strategies|change location|insights|search|contact|careers|about us|skip to content|our funds
导航菜单|关于我们|机构客户|首页|联系我们|登录|投资策略|搜索|研究观点|切换语言|旗下产品|加入我们
suche|über uns|karriere|kontakt|einblicke|zum inhalt springen|anmelden|fonds|startseite
nos fonds|recherche|nous contacter|qui sommes-nous|connexion|analyses|accueil
quiénes somos|inicio|contacto|nuestros fondos|buscar|análisis|acceso clientes
レポート一覧|運用商品|サイト内検索|ホーム|ログイン|お問い合わせ|会社案内
"""
#: Words by which other furniture gives itself away, by language (fixed values).
FURNITURE = """
cookie|browser|partners process|accept all|privacy|preferences|consent|withdraw your|device data|past performance|not a guide|views expressed|terms of use|sitemap|accessibility|professional investor|not an offer|capital is at risk|^complaints$|^fraud alert$|back to top|^follow us|^print$|copy link|download as pdf|share this|enter your e-?mail|join more than|sign up|subscribe now|weekly letter|i have read and accept|select your country|all rights reserved|authorised and supervised|^©|in your inbox|register free|unlock the full|^advertisement|^tags?:|^page \\d+ of|loading chart|previous \\| next|was this page|session will end|reprints and perm|\\d+ comments|listen to this
版权所有|版權所有|^广告$|^廣告$|标签：|標签：|標簽|標籤|不构成任何|不構成任何|评论（|評論（|收听本文|收聽本文|图表加载|圖表加載|圖表加载|上一篇|注册会员|註冊會員|第 ?\\d+ ?页|缓存文件|緩存文件|偏好设置|偏好設置|全部接受|点击同意|點擊同意|投诉电话|投訴電話|投资需谨慎|投資需谨慎|投資需謹慎|隐私政策|隱私政策|使用条款|免责声明|免責聲明|仅供专业|僅供專業|僅供专业|字号：|字號：|请输入邮箱|請輸入郵箱|订阅|訂閱|返回顶部|分享到|打印本|下载全文|下載全文|您属于合格|已阅读并同意|已閱讀|公众号|公眾號|存储相关信息|存儲相關信息|收集必要的|撤回授
alle akzeptieren|einwilligung|einstellungen verwalten|wertentwicklung|professionelle anleger|professioneller anleger|impressum|datenschutz|seite drucken|nach oben|artikel teilen|e-mail-adresse|newsletter abonnieren|alle rechte|kommentare|anzeige$|registrieren|schlagwörter|schlagworte|jeden freitag|seite \\d+ von|diagramm wird
tout accepter|mes choix|votre accord|audience du site|performances pass|investisseurs? professionnels?|mentions l|s'abonner|haut de page|imprimer la page|partager cet|tous droits|chaque vendredi|\\d+ commentaires?$|publicité|mots-clés|adresse e-mail|inscrivez|page \\d+ sur
aceptar todas|gestionar pref|su consentimiento|uso de esta página|rentabilidades pasadas|inversor(?:es)? profesional|aviso legal|suscríbase|volver arriba|imprimir página|compartir este|derechos reservados|cada viernes|comentarios|publicidad|etiquetas|regístrese|página \\d+ de
すべて同意|設定を管理|同意はいつでも|クッキーを使い|将来の成果を保証|専門家向け|利用規約|個人情報|メール配信|ページの先頭|ページを印刷|記事を共有|無断転載|プロの投資家|週次レポート|コメント|広告$|タグ|会員登録|メールアドレス
"""
#: Headings over teasers, by language (fixed values).
TEASER_HEADINGS = """
you may also like|up next|related insights|more from this author|most read this week|view all articles|view all
热门文章|熱門文章|下一篇|相关阅读|相關閱讀|相關阅读|猜您喜欢|猜您喜歡|查看全部
meistgelesen|alle beiträge anzeigen|das könnte sie auch interessieren
les plus lus|voir tous les articles|à lire aussi|a lire aussi
lo más leído|ver todos los artículos|ver todos los articulos|lo mas leido|también le puede interesar|tambien le puede interesar
関連レポート|一覧を見る|次の記事|よく読まれている記事
"""
#: What articles themselves say about such things (fixed values).
ARTICLE = "cookies disappear|third-party cookies|pay less|newsletter and podcast|five year view|订阅用户|訂閱用户|訂閱用戶|隐私授权|隱私授權|隐私授權|cookies tiers|abonnements reculent|newsletter von|boletín de|cookies de terceros|配信サービス"


def _any(words: str, whole: bool = False) -> re.Pattern:
    joined = "|".join(line for line in words.strip().split("\n"))
    return re.compile(f"^(?:{joined})$" if whole else joined, re.I)


NAV_ENTRIES = frozenset(x.strip() for x in re.split(r"[|\n]", NAVIGATION) if x.strip())
SPEAKS, HEADS, ENDS, OWN = _any(FURNITURE), _any(TEASER_HEADINGS, whole=True), TEASER_END, re.compile(ARTICLE, re.I)
SIMPLE = str.maketrans("關於機構客戶頁聯繫係錄資產觀點換語導單們尋", "关于机构客户页联系系录资产观点换语导单们寻")


def is_navigation(line: str) -> bool:
    parts = [x.strip().lower().translate(SIMPLE) for x in re.split(r"\s*[|·>»/]\s*|\s{2,}|\s[-–]\s", line) if x.strip()]
    return bool(parts) and 2 * sum(x in NAV_ENTRIES for x in parts) >= len(parts)


def teach(lines: list[str]) -> tuple[list[int], list[tuple[int, int]]]:
    """Labels of lines (1 furniture, 0 article, -1 not known) and the extents of teaser blocks that are known."""
    lines = [s.strip() for s in lines]
    sure = [1 if HEADS.match(s) or ENDS.search(s) or is_navigation(s) or len(s) < 170 and SPEAKS.search(s) and not OWN.search(s) else 0 for s in lines]
    out, blocks = list(sure), []
    for i, s in enumerate(lines):
        if not HEADS.match(s):
            continue
        last = i
        for k in range(i + 1, min(i + 4, len(lines))):
            if sure[k] and not ENDS.search(lines[k]):
                break
            if ENDS.search(lines[k]):
                last = k
        stop = next((k for k in range(last + 1, min(i + 5, len(lines))) if sure[k] and not ENDS.search(lines[k])), None)
        if stop is not None and stop - i - 1 <= 3:  # the block runs up to other furniture
            last = stop - 1
            if last > i:
                blocks.append((i, last + 1))
        out[i + 1 : last + 1] = [1] * (last - i)
        if last == i and i + 1 < len(lines):
            out[i + 1] = 1
            last = i + 1
        if stop is None or stop - i - 1 > 3:
            for k in range(last + 1, min(i + 4, len(lines))):
                if not sure[k]:
                    out[k] = -1
    return out, blocks


def compose(pages: list[list[str]], rng: random.Random, copies: int) -> list[tuple[list[str], list[int]]]:
    """Real pages with the teacher's labels, and pages put together from parts of them."""
    taught = [(p, *teach(p)) for p in pages]
    teasers = [p[a:b] for p, _, blocks in taught for a, b in blocks]
    out = [(p, y) for p, y, _ in taught]
    for _ in range(copies):
        for p, y, blocks in taught:
            inside = {k for a, b in blocks for k in range(a, b)}
            if -1 in y:
                continue
            lines = [(s, v) for k, (s, v) in enumerate(zip(p, y, strict=True)) if k not in inside]
            body = [k for k, (_, v) in enumerate(lines) if not v]
            for block in rng.sample(teasers, min(len(teasers), rng.choice((0, 1, 1, 2)))):
                at = rng.choice(body) + 1 if body and rng.random() < 0.8 else len(lines)
                lines[at:at] = [(s, 1) for s in block]
                body = [k for k, (_, v) in enumerate(lines) if not v]
            if rng.random() < 0.15 and len(lines) > 6:  # previews are cut
                lines = lines[: rng.randint(4, len(lines))]
            out.append(([s for s, _ in lines], [v for _, v in lines]))
    return out


def train(pages, epochs: int = 5, batch: int = 48, rate: float = 3e-3, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights by backpropagation through time and Adam, in numpy."""
    rng = np.random.default_rng(seed)
    glorot = lambda a, b: (rng.standard_normal((a, b)) * np.sqrt(2 / (a + b))).astype(np.float32)
    w = {"embedding": (rng.standard_normal((BUCKETS, WIDTH)) * 0.3).astype(np.float32), "v": glorot(2 * HIDDEN + WIDTH, 1)[:, 0], "c": np.zeros(1, np.float32)}
    for side in ("left", "right"):
        w[f"w_{side}"], w[f"u_{side}"] = glorot(WIDTH, 4 * HIDDEN), glorot(HIDDEN, 4 * HIDDEN)
        w[f"b_{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
    first, second = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}
    seen: dict[str, list[int]] = {}
    data = [([seen[s] if s in seen else seen.setdefault(s, block_features(s)) for s in p], np.array(y, np.float32)) for p, y in pages if p]

    def forward(x, side):
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        kept = []
        for t in range(steps):
            z = x[t] @ w[f"w_{side}"] + h @ w[f"u_{side}"] + w[f"b_{side}"]
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            kept.append((i, f, o, g, c, tc, h))
            c, h = c_new, o * tc
            kept[-1] += (h,)
        return np.stack([k[7] for k in kept]), kept

    def backward(x, dh_all, kept, side, grad):
        dx = np.zeros_like(x)
        dh_next, dc_next = np.zeros_like(dh_all[0]), np.zeros_like(dh_all[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, c, tc, h, _ = kept[t]
            dh = dh_all[t] + dh_next
            dc = dc_next + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            grad[f"w_{side}"] += x[t].T @ dz
            grad[f"u_{side}"] += h.T @ dz
            grad[f"b_{side}"] += dz.sum(0)
            dx[t] = dz @ w[f"w_{side}"].T
            dh_next, dc_next = dz @ w[f"u_{side}"].T, dc * f
        return dx

    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        order = order[np.argsort([len(data[k][0]) + rng.integers(0, 6) for k in order], kind="stable")]
        starts = rng.permutation(np.arange(0, len(order), batch))
        total = count = 0.0
        for s in starts:
            chosen = [data[k] for k in order[s : s + batch]]
            steps, n = max(len(p) for p, _ in chosen), len(chosen)
            x, y = np.zeros((steps, n, WIDTH), np.float32), np.full((steps, n), -1, np.float32)
            dropped = []
            for j, (p, labels) in enumerate(chosen):
                for t, buckets in enumerate(p):
                    b = np.array(buckets)
                    if len(b) > 4:
                        b = b[rng.random(len(b)) > 0.25] if rng.random() < 0.9 else b  # words unseen later must not matter too much
                    if not len(b):
                        b = np.array(buckets)
                    x[t, j] = w["embedding"][b].mean(0)
                    dropped.append((t, j, b))
                y[: len(p), j] = labels
            lengths = np.array([len(p) for p, _ in chosen])
            flip = np.zeros((steps, n), np.int64)
            for j, m in enumerate(lengths):
                flip[:, j] = np.concatenate([np.arange(m)[::-1], np.arange(m, steps)])
            cols = np.arange(n)[None, :]
            left, kept_l = forward(x, "left")
            right_r, kept_r = forward(x[flip, cols], "right")
            right = right_r[flip, cols]
            both = np.concatenate([left, right, x], axis=2)
            p = sigmoid(both @ w["v"] + w["c"])
            known = y >= 0
            total += float(-(np.log(np.where(y == 1, p, 1 - p) + 1e-7) * known).sum())
            count += known.sum()
            d = np.where(known, p - y, 0) / max(1, known.sum())
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            grad["v"], grad["c"] = np.tensordot(d, both, axes=([0, 1], [0, 1])), np.array([d.sum()], np.float32)
            d_both = d[:, :, None] * w["v"]
            dx = d_both[:, :, 2 * HIDDEN :] + backward(x, d_both[:, :, :HIDDEN], kept_l, "left", grad)
            dx_r = backward(x[flip, cols], d_both[:, :, HIDDEN : 2 * HIDDEN][flip, cols], kept_r, "right", grad)
            dx += dx_r[flip, cols]
            rows = np.concatenate([b for _, _, b in dropped])
            parts = np.repeat(np.stack([dx[t, j] / len(b) for t, j, b in dropped]), [len(b) for _, _, b in dropped], axis=0)
            np.add.at(grad["embedding"], rows, parts)
            step += 1
            lr = rate * min(1, step / 50) * (0.35 if epoch >= epochs - 2 else 1)
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                w[k] -= (lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        print(f"epoch {epoch}: loss {total / count:.4f}", flush=True)
    return w


def evaluate(path: str, pages) -> dict[str, float]:
    model = BlockLabeller(path)
    scores = model.label([p for p, _ in pages])
    right = known = miss = false = 0
    for s, (_, y) in zip(scores, pages, strict=True):
        y = np.array(y)
        ok = y >= 0
        known += ok.sum()
        right += ((s > 0.5) == y)[ok].sum()
        miss += ((s <= 0.5) & (y == 1)).sum()
        false += ((s > 0.5) & (y == 0)).sum()
    return {"lines": int(known), "accuracy": float(right / known), "missed": int(miss), "wrongly_dropped": int(false)}


def main(source: str, out: str = WEIGHTS) -> None:
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(source, columns=["text_preview"])["text_preview"].to_pylist() if t and t.strip()]
    pages = [[s for s in t.split("\n") if s.strip()] for t in texts]
    rng = random.Random(1)
    rng.shuffle(pages)
    held = len(pages) // 8
    weights = train(compose(pages[held:], rng, 4), epochs=6)
    np.savez_compressed(out, **{k: x.astype(np.float16) for k, x in weights.items()})
    print("held out, as they are:", evaluate(out, compose(pages[:held], rng, 0)))
    print("held out, put together:", evaluate(out, compose(pages[:held], rng, 1)[held:]))


if __name__ == "__main__":
    main(*sys.argv[1:])
