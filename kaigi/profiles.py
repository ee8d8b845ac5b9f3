"""What differs between the two kinds of minutes, as data."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path

# Stop words and category names.  Lists over about 200 entries (the council's stop words for speakers, all
# category words) are parameters: see stop_words_from and categories_from.
PARLIAMENT_SESSION_STOPS = """
する ある いる なる れる られる ない 言う 思う 考える 行う 行なう 関する おける つく でる みる くる いく もらう くれる できる おる いただく
頂く ございます おります 申し上げる 申す 存じる この その あの これ それ あれ 此れ 其れ 其の 此の ここ そこ あそこ こちら そちら あちら
こと もの ため よう わけ はず ところ とき 場合 方 上 中 内 以上 以下 以内 以外 程度 関係 問題 状況
議長 副議長 委員長 議員 大臣 大臣官房 委員 委員会 分科会 小委員会 衆議院 参議院 国会 両院 本会議 内閣 政府 行政 国務 国務大臣
提案 審議 採決 可決 否決 議案 法案 説明 質問 答弁 質疑 討論 一般質疑 開会 閉会 休憩 再開 賛成 反対 異議 日程 進行 報告 承認 同意
発言 お答え 先生 大変 元年 年度 今年 来年 昨年 本年 明治 大正 昭和 平成 令和 午前 午後
及び 並びに または あるいは もしくは について において による ついて おいて よる ○ ◎ ● ■ □ △ ▲ ・
""".split()
COUNCIL_SESSION_STOPS = """
する ある いる なる れる られる ない 言う 思う 考える 行う 行なう 関する おける つく でる みる くる いく もらう くれる できる おる いただく
頂く ございます おります 申し上げる 申す 存じる この その あの これ それ あれ 此れ 其れ 其の 此の 彼れ 彼の ここ そこ あそこ こちら そちら あちら
こと もの ため よう わけ はず ところ とき 場合 方 上 中 内 以上 以下 以内 以外 程度 関係 問題 状況
議長 市長 議員 宮古島 宮古島市 会議 議会 副議長 委員 委員会 提案 審議 採決 可決 議案 説明 質問 答弁 討論 一般質問 定例会 臨時会
市議会 開会 閉会 休憩 再開 賛成 反対 異議 日程 進行 報告 承認 同意 元年 年度 今年 来年 昨年 本年 本市
○ ◎ ● ■ □ △ ▲ ・ について において による ついて おいて よる 及び 並びに または あるいは もしくは
""".split()
PARLIAMENT_SPEAKER_STOPS = """
言う つく 此れ 其れ 其の 此の 成る 有る 居る 致す 掛かる 受ける 関する 行う 行なう 出る 入る 見る 置く 来る 対する 付く 取る 当たる 係る 伴う
図る 向ける 与える 設ける 基づく 求める する ある いる なる れる られる ない 思う 考える おける でる みる くる いく もらう できる おる いただく
頂く ございます おります 申し上げる 申す 存じる この その あの これ それ あれ ここ そこ あそこ こちら そちら あちら
こと もの ため よう わけ はず ところ とき 場合 方 上 中 内 以上 以下 以内 以外 程度 関係 問題 状況
議長 副議長 委員長 議員 大臣 委員 委員会 衆議院 参議院 国会 両院 本会議 分科会 内閣 政府 行政 国務 国務大臣
提案 審議 採決 可決 否決 議案 法案 説明 質問 答弁 質疑 討論 開会 閉会 休憩 再開 賛成 反対 異議 日程 進行 報告 承認 同意 発言
年度 今年 来年 昨年 本年 元年 明治 大正 昭和 平成 令和 午前 午後
事業 施設 計画 支援 管理 地域 今後 職員 本当 理解 部分 利用 整備 促進 推進 検討 協力 実現 確認 把握 活用 強化 改善 充実 向上 確保 適切
国民 国内 制度 措置 対応 必要 及び 並びに または あるいは もしくは について において による ついて おいて よる
""".split()
PARLIAMENT_CATEGORIES = "社会保障・福祉 医療・健康 教育・科学技術 国土・インフラ・交通 農業・食料 経済・産業・雇用 環境・エネルギー 財政・税制 行政・議会運営 安全保障・外交・防衛 憲法・司法・人権 地方・地域振興".split()
COUNCIL_CATEGORIES = "暮らし・福祉 医療・健康 子ども・教育 まちづくり・インフラ 農業・水産業 観光・産業 環境・防災 財政・税金 行政・議会運営 安全保障・基地問題".split()


def stop_words_from(path: str) -> list[str]:
    """One word to a line; missing files raise FileNotFoundError."""
    return [x.strip() for x in Path(path).read_text(encoding="utf-8").splitlines() if x.strip()]


def categories_from(path: str) -> list[tuple[int, str, str]]:
    """(cat_seq, category, word) from a JSON object {category: [word, ...]} in its order."""
    return [(i, name, w) for i, (name, found) in enumerate(json.loads(Path(path).read_text(encoding="utf-8")).items()) for w in dict.fromkeys(found)]


@dataclass(frozen=True)
class TokenRules:
    """Which tokens stay; stop: words that go, None where they have yet to be given."""

    stop: tuple[str, ...] | None = ()
    max_length: int | None = None
    drop_persons: bool = False
    drop_counters: bool = False
    katakana: str = "always"
    drop_hyphen: bool = True
    drop_eras: bool = False
    drop_title: bool = False


@dataclass(frozen=True)
class Profile:
    name: str
    header: str
    min_utterances: int
    fold_variants: bool
    strip_markers: bool
    categories: tuple[str, ...]
    session_rules: TokenRules
    speaker_rules: TokenRules
    space_in_files: str
    category_words: tuple[tuple[int, str, str], ...] = field(default=())
    top_session_terms: int = 30
    top_speaker_terms: int = 200
    max_features: int = 10_000
    session_df: tuple[int, float] = (2, 0.7)
    speaker_df: tuple[int, float] = (2, 0.6)

    def with_speaker_stops(self, words: list[str] | tuple[str, ...]) -> Profile:
        """The profile with stop words for speakers; the council's has none until they are given."""
        return replace(self, speaker_rules=replace(self.speaker_rules, stop=tuple(words)))


PARLIAMENT = Profile(
    "parliament", r"^==== (.+?) \d{4}-\d{2}-\d{2} ====$", 10, False, True, tuple(PARLIAMENT_CATEGORIES),
    TokenRules(tuple(PARLIAMENT_SESSION_STOPS), max_length=10, drop_persons=True, katakana="proper"), TokenRules(tuple(PARLIAMENT_SPEAKER_STOPS), drop_counters=True, drop_title=True), "_",
)
COUNCIL = Profile(
    "council", r"^==== (.+?) \d{4}-\d{2}-\d{2}(?:〜\d{4}-\d{2}-\d{2})? ====$", 50, True, False, tuple(COUNCIL_CATEGORIES),
    TokenRules(tuple(COUNCIL_SESSION_STOPS), drop_eras=True), TokenRules(None, drop_counters=True, drop_title=True), "",
)
