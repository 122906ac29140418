"""Chat templates and prompt rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_STOP = "</s>"

# Name, system prompt, user role, bot role, prompt, separator, stop string of every template.
TEMPLATES = [
    ("vicuna",
     "A chat between a curious user and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the user's questions.",
     "USER", "ASSISTANT", "USER: {query} ASSISTANT:", "</s>", DEFAULT_STOP),
    ("base", "", "USER", "ASSISTANT", "{query}", "</s>", DEFAULT_STOP),
    ("alpaca",
     "Below is an instruction that describes a task. "
     "Write a response that appropriately completes the request.",
     "### Instruction", "### Response", "### Instruction:\n{query}\n\n### Response:\n", "\n\n", DEFAULT_STOP),
    ("baichuan", "", "<reserved_102>", "<reserved_103>", "<reserved_102>{query}<reserved_103>", "</s>", DEFAULT_STOP),
    ("baichuan2", "", "<reserved_106>", "<reserved_107>", "<reserved_106>{query}<reserved_107>", "</s>", DEFAULT_STOP),
    ("ziya", "", "<human>", "<bot>", "<human>:{query}\n<bot>:", "\n", DEFAULT_STOP),
    ("linly", "", "User", "Bot", "User: {query}\nBot: ", "\n", DEFAULT_STOP),
    ("chatglm", "", "问", "答", "问：{query}\n答：", "\n", DEFAULT_STOP),
    ("chatglm2", "", "问", "答", "问：{query}\n\n答：", "\n\n", DEFAULT_STOP),
    ("chatglm3", "", "<|user|>", "<|assistant|>", "<|user|>\n{query}<|assistant|>", "\n", "<|user|>"),
    ("phoenix",
     "A chat between a curious human and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the human's questions.\n\n",
     "Human", "Assistant", "Human: <s>{query}</s>Assistant: ", "</s>", DEFAULT_STOP),
    ("belle", "", "Human", "Belle", "Human: {query}\n\nBelle: ", "\n\n", DEFAULT_STOP),
    ("aquila",
     "A chat between a curious human and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the human's questions.",
     "Human", "Assistant", "Human: {query}###Assistant:", "###", DEFAULT_STOP),
    ("intern", "", "<|User|>", "<|Bot|>", "<|User|>:{query}<eoh>\n<|Bot|>:", "<eoa>\n", "<eoa>"),
    ("intern2",
     "<|im_start|>system\nYou are an AI assistant whose name is InternLM (书生·浦语).\n<|im_end|>\n",
     "user", "assistant", "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "<|im_end|>\n", "<|im_end|>"),
    ("starchat", "<system>\n", "<|user|>", "<|assistant|>", "<|user|>\n{query}<|end|>\n<|assistant|>\n", "<|end|>\n", "<|end|>"),
    ("llama2",
     "<<SYS>>\nYou are a helpful, respectful and honest assistant. "
     "Always answer as helpfully as possible, while being safe. "
     "Your answers should not include any harmful, unethical, racist, sexist, "
     "toxic, dangerous, or illegal content. "
     "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
     "If a question does not make any sense, or is not factually coherent, "
     "explain why instead of answering something not correct. "
     "If you don't know the answer to a question, please don't share false information.\n<</SYS>>\n\n",
     "[INST]", "[/INST]", "[INST] {query} [/INST]", "</s>", DEFAULT_STOP),
    ("llama3",
     "<|start_header_id|>system<|end_header_id|>\n\nYou are a helpful, excellent and smart assistant.",
     "user", "assistant",
     "<|start_header_id|>user<|end_header_id|>\n\n{query}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
     "<|eot_id|>", "<|eot_id|>"),
    ("llama2-zh",
     "[INST] <<SYS>>\nYou are a helpful assistant. 你是一个乐于助人的助手。\n<</SYS>>\n\n [/INST]",
     "[INST]", "[/INST]", "[INST] {query} [/INST]", "</s>", DEFAULT_STOP),
    ("mistral", "", "[INST]", "[/INST]", "[INST] {query} [/INST]", "</s>", DEFAULT_STOP),
    ("xverse", "", "Human", "Assistant", "Human: {query}\n\nAssistant: ", "</s>", DEFAULT_STOP),
    ("chatml", "You are a helpful assistant.", "user", "assistant",
     "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "<|im_end|>\n", "<|im_end|>"),
    ("deepseek", "<BOS_TOKEN>", "User", "Assistant",
     "<|START_OF_TURN_TOKEN|><|USER_TOKEN|>{query}<|END_OF_TURN_TOKEN|><|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>",
     "</s>", DEFAULT_STOP),
    ("deepseek3", "", "<｜User｜>", "<｜Assistant｜>", "<｜User｜>{query}<｜Assistant｜>", "</s>", DEFAULT_STOP),
    ("deepseekcoder",
     "You are an AI programming assistant, utilizing the Deepseek Coder model, "
     "developed by Deepseek Company, and you only answer questions related to computer science. "
     "For politically sensitive questions, security and privacy issues, "
     "and other non-computer science questions, you will refuse to answer\n",
     "### Instruction", "### Response", "### Instruction:\n{query}\n### Response:\n", "\n", "<|EOT|>"),
    ("yi", "", "user", "assistant", "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "\n", "<|im_end|>"),
    ("orion", "", "Human", "Assistant", "Human: {query}\n\nAssistant: </s>", "</s>", DEFAULT_STOP),
    ("cohere", "<BOS_TOKEN>", "User", "Assistant",
     "<|START_OF_TURN_TOKEN|><|USER_TOKEN|>{query}<|END_OF_TURN_TOKEN|><|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>",
     "</s>", DEFAULT_STOP),
    ("qwen", "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n", "user", "assistant",
     "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "\n", "<|im_end|>"),
]
# Fixed value: the one prompt whose published form loses the query; used only with ``compat=True``.
LOSSY_PROMPTS = {"deepseekcoder": "### Instruction:\n{content}\n### Response:\n"}

COLUMNS = ["name", "template_system", "role_user", "role_bot", "prompt", "sep", "stop_str"]


def template_table(spark: SparkSession, compat: bool = False) -> DataFrame:
    """The templates as a 29-row table (numbered by ``template_id``), meant to be broadcast."""
    rows = []
    for i, t in enumerate(TEMPLATES):
        t = list(t)
        if compat:
            t[4] = LOSSY_PROMPTS.get(t[0], t[4])
        rows.append((i, *t))
    schema = "template_id int, " + ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame(rows, schema)


def with_template(df: DataFrame, template_id: Column, compat: bool = False) -> DataFrame:
    """Look up each row's template."""
    t = F.broadcast(template_table(df.sparkSession, compat))
    return df.withColumn("template_id", template_id.cast("int")).join(t, "template_id")


def with_named_template(df: DataFrame, name: str, compat: bool = False) -> DataFrame:
    ids = [t[0] for t in TEMPLATES]
    return with_template(df, F.lit(ids.index(name)), compat)


def effective_system(system: Column) -> Column:
    """The caller's system prompt if it is non-empty, else the template's own."""
    return F.coalesce(F.nullif(system, F.lit("")), F.col("template_system"))


def render_query(idx: Column, query: Column, system: Column) -> Column:
    """The text put before answer number ``idx`` of a dialog, on a row that carries its template."""
    asked = F.replace(F.col("prompt"), F.lit("{query}"), query)
    own = effective_system(system)
    opening = F.when(own != "", F.concat(own, F.col("sep"))).otherwise(F.lit(""))
    return F.concat(F.when(idx == 0, opening).otherwise(F.col("sep")), asked)


def render_history(history: Column, system: Column) -> Column:
    """One prompt string from an array of ``[query, answer]`` arrays held in a row."""
    pieces = F.transform(
        history, lambda p, i: F.concat(render_query(i, F.get(p, F.lit(0)), system), F.get(p, F.lit(1)))
    )
    return F.array_join(pieces, "")
