"""Word lists, rule tables and templates that results depend on."""

#: Link texts that hold one of these are not followed.
LINK_STOP_WORDS = (
    "宏大叙事", "不确定性", "争议", "参考文献", "外部链接", "参见", "注释", "脚注", "分类", "隐私政策", "免责声明",
    "版权", "联系我们", "帮助", "用户手册", "使用条款", "存档", "讨论", "编辑", "历史", "上传文件", "特殊页面",
)
ENTITY_TYPES = ("Person", "Organization", "Location", "Event", "Product", "Concept", "Date", "Number", "Chemical", "Award", "Publication", "Technology")
#: Relations that count as predefined.
RELATIONS = (
    "创作者", "导演", "作者", "创立者", "开发者", "配偶", "父亲", "兄弟姐妹", "结婚对象", "毕业于", "就职于", "成员",
    "发生年份", "出生年份", "成立年份", "发布时间", "位于", "出生地", "总部位于", "具有属性", "基于", "化学分子式", "定义",
    "早于", "相同", "导致", "受影响于", "影响", "贡献", "获得奖项", "提名奖项", "颁发奖项", "主演", "参演", "制片人",
    "研究领域", "研究目标", "研究方法", "研究内容", "研究历史", "发展阶段", "成立时间", "发布模型",
)
SIMILARITY = 0.90

#: Rules against merging: pairs of words of which one name holds the one and the other name the other.
KEYWORD_CONFLICTS = (("男", "女"), ("男性", "女性"), ("男主角", "女主角"), ("最佳", "最差"), ("获奖", "提名"), ("电影", "电视剧"), ("导演", "演员"), ("制片人", "编剧"))
SEMANTIC_CONFLICTS = (
    ("深度学习", "深度学习之父"), ("人工智能", "人工智能之父"), ("机器学习", "机器学习专家"), ("深度学习", "深度学习发展"), ("人工智能", "人工智能发展"),
    ("人工智能", "人工智能概念"), ("机器学习", "机器学习历史"), ("神经网络", "神经网络历史"), ("技术", "概念"), ("理论", "实践"), ("方法", "结果"), ("大学", "教授"), ("公司", "博士"),
)
TYPE_WORDS = {
    "person": ("之父", "之母", "专家", "学者", "教授", "博士", "先生", "女士", "院士", "员", "家", "师", "长", "主任", "经理", "总裁", "董事", "主席"),
    "concept": ("概念", "理论", "思想", "原理", "定义"),
    "process": ("发展", "历史", "演进", "过程", "阶段", "趋势"),
    "technology": ("技术", "方法", "算法", "模型", "系统"),
    "organization": ("公司", "企业", "机构", "组织", "团队", "实验室", "院", "所", "会", "司", "厂", "店", "馆", "部", "科", "组", "队"),
    "event": ("会议", "大会", "论坛", "比赛", "竞赛", "活动"),
}
PERSON_ENDS = ("员", "家", "师", "长", "主任", "经理", "总裁", "董事", "主席", "人")
ORGANIZATION_ENDS = ("院", "所", "会", "司", "厂", "店", "馆", "部", "科", "组", "队")
#: One of these in what a longer name adds to a shorter one tells them apart.
DISTINCT_PARTS = "星华明强伟峰霞娟丽红院所会司厂店馆楼室部科组队梅兰芳雯雅婷洁静敏颖慧佳美君雄飞翔宇辉鹏涛磊刚勇军波"
NUMBER = r"^[零一二三四五六七八九十百千万0-9]+(年)?$"

ANCHOR_WORDS = "年|月|日|省|市|县|区|国|州|university|company|organization|group"
ANCHOR_CLASSES = (
    ("temporal", "年|月|日|year|date|^[0-9]+$"),
    ("geographical", "省|市|县|区|国|州|city|country|province"),
    ("institutional", "university|company|organization|school|group|大学|公司|机构"),
    ("categorical", "type|category|类|种|型"),
)
CHAIN_PAYLOADS = ("identity", "属性", "关系", "特征", "性质", "定义", "分类", "来源", "用途", "作用")
CROSS_PAYLOADS = ("交叉验证", "综合分析", "多源确认", "关联推理", "汇聚点识别")
#: Weights of chain, cross and anchor samples, and ranges of lengths, by complexity.
MIX_DEFAULT = {"chain": 0.6, "cross": 0.25, "anchor": 0.15}
MIX_LEVELS = {
    "low": ({"chain": 0.8, "cross": 0.15, "anchor": 0.05}, (2, 4), (2, 3), (3, 4)),
    "medium": ({"chain": 0.6, "cross": 0.25, "anchor": 0.15}, (3, 6), (2, 4), (3, 5)),
    "high": ({"chain": 0.4, "cross": 0.35, "anchor": 0.25}, (4, 7), (3, 5), (4, 6)),
}

#: General descriptions: the first rule that fits. Patterns over the name.
GENERIC = (
    ("公司|集团|有限|股份|科技|工业|商业", "一家知名企业"),
    ("大学|学院|学校|教育", "一所教育机构"),
    ("医院|诊所|卫生", "一个医疗机构"),
    ("银行|保险|证券|基金|金融", "一个金融机构"),
    ("电影|电视剧|纪录片|动画", "一部影视作品"),
    ("歌曲|专辑|音乐", "一首音乐作品"),
    ("小说|散文|诗歌|著作|作品", "一部文学作品"),
    ("^[^0-9]{0,4}$", "一位人物"),
    ("市|省|县|区|街道|路", "一个地理位置"),
    ("年|月|日|时期|朝代", "一个时间点"),
    ("[0-9]", "一个数值"),
    ("^.{0,6}$", "相关对象"),
)
GENERIC_ELSE = "相关内容"
GENERAL = (("大学|学院|学校", "一所教育机构"), ("公司|集团|企业", "一个组织"), ("书|著作|作品", "一部作品"), ("人|家|者", "一位人物"))
GENERAL_ELSE = "一个相关概念"
QUESTION_STEMS = ("根据以上描述，这个网络最终指向的核心概念是什么？", "通过这些关联信息，最终的目标是什么？", "基于这些线索，答案是什么？", "这个关联链的终点是什么？")
CHAIN_STEMS = ("这个网络最终指向的核心概念是什么？", "通过这些关联，最终会到达哪个目标？", "这个关联链的终点是什么？", "根据这些线索，最终的答案是什么？")
CHAIN_STORY = "在某个研究领域，一个重要的起点与多个相关概念存在连接。这些概念之间形成了一个复杂的关联网络。"
NO_STORY = "在某个复杂的关联网络中，多个要素之间存在着密切的联系。"
NO_FACTS = "相关实体间存在某种关联"
SOME_ENTITY = "某个相关实体"
ANALYSIS = ("1. 整合背景信息中的多个关键要素，发现它们形成一个关联网络。", "2. 通过分析{n}个线索实体之间的逻辑关系，建立推理链条。", "3. 结合所有信息进行综合推理，确定最终答案。")
