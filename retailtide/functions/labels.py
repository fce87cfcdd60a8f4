"""Labels of the dashboard's answers."""

# These texts are part of the answers and must stay as they are.
METRICS = {
    "dau": "新增日活",
    "new_mid": "新增设备",
    "order_amount": "新增交易额",
}
STAT_TITLES = {"gender": "性别占比", "age": "年龄段占比"}
GENDERS = {"M": "男", "F": "女"}
AGE_BANDS = {"under_20": "20岁以下", "from_20_to_30": "20岁到30岁", "over_30": "30岁以上"}
