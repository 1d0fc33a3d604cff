"""Job options and the fixed values the data format depends on.

Everything a job can vary is a field of a frozen dataclass; the values below
marked FIXED must keep exactly these values for outputs to line up with data
prepared elsewhere (token ids, chat markup, prompts).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the upstream data format; do not edit)
# ---------------------------------------------------------------------------

# Special tokens in id order 0..4.
SPECIAL_TOKENS = ("<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>")
UNK_ID = 0
BOS_TOKEN = "<|im_start|>"
EOS_TOKEN = "<|im_end|>"
BOS_ID = 3
EOS_ID = 4
PAD_ID = 0
# Ids 5..260 are the 256 byte symbols; merges start after them.
FIRST_BYTE_ID = 5
FIRST_MERGE_ID = 261
VOCAB_SIZE = 6144

# Chat markup: per message "<|im_start|>{role}\n{content}<|im_end|>\n";
# only these roles render, anything else renders as nothing.
CHAT_ROLES = ("system", "user", "assistant")
GENERATION_PROMPT = "<|im_start|>assistant\n"

# System message prepended by corpus chat preparation.
PREPARE_SYSTEM_PROMPT = "你是一个AI助手"
# System message used when rendering sampling prompts. Three characters are
# Kangxi radicals (U+2F00, U+2F3F, U+2F29) and it ends with a space.
SAMPLING_SYSTEM_PROMPT = "你是\u2f00个AI助\u2f3f，你的名字叫\u2f29明。 "

# Source chat roles kept by chat preparation and their output roles.
CHAT_ROLE_MAP = (("human", "user"), ("assistant", "assistant"))

# Python's str.strip()/isspace() set, 29 code points.
BLANK_CODE_POINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0,
    0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# GPT-2 style byte-level pre-tokenizer pattern.
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Defaults of the preparation and training configuration.
CHUNK_WIDTH = 512
MAX_LENGTH = 512
BATCH_SIZE = 48
ACCUMULATION_STEPS = 8
LEARNING_RATE = 2e-4
WARMUP_ITERS = 0
EPOCHS = 1
LOG_INTERVAL = 100
SAVE_INTERVAL = 1000
TAGGED_SAVE_INTERVAL = 20000
SEED = 42
CORPUS_REJECT_SAMPLES = 10
CHAT_REJECT_SAMPLES = 5
EXCERPT_CHARS = 50
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CorpusOptions:
    chunk_width: int = CHUNK_WIDTH
    reject_samples: int = CORPUS_REJECT_SAMPLES
    excerpt_chars: int = EXCERPT_CHARS


@dataclass(frozen=True)
class ChatOptions:
    system_prompt: str = PREPARE_SYSTEM_PROMPT
    role_map: tuple = CHAT_ROLE_MAP
    reject_samples: int = CHAT_REJECT_SAMPLES
    excerpt_chars: int = 200


@dataclass(frozen=True)
class SampleOptions:
    max_length: int = MAX_LENGTH
    pad_id: int = PAD_ID
    bos: str = BOS_TOKEN
    end_id: int = EOS_ID


@dataclass(frozen=True)
class RunOptions:
    batch_size: int = BATCH_SIZE
    epochs: int = EPOCHS
    seed: int = SEED
    learning_rate: float = LEARNING_RATE
    warmup_iters: int = WARMUP_ITERS
    accumulation_steps: int = ACCUMULATION_STEPS
    log_interval: int = LOG_INTERVAL
    save_interval: int = SAVE_INTERVAL
    tagged_save_interval: int = TAGGED_SAVE_INTERVAL


@dataclass(frozen=True)
class SelectOptions:
    """Decoding choice over scored candidates.

    ``do_sample=False, num_beams=1`` means greedy (the documented meaning).
    """

    max_new_tokens: int = 256
    temperature: float = 1.0
    top_k: int | None = None
    do_sample: bool = False
    num_beams: int = 1
    stop_id: int | None = None
    num_samples: int = 1
    seed: int = SEED
    extra: dict = field(default_factory=dict)

    def normalised(self) -> "SelectOptions":
        t = self.temperature if self.temperature > 0 else 0.001
        b = self.num_beams if self.num_beams >= 1 else 1
        k = self.top_k if (self.top_k is not None and self.top_k >= 1) else None
        return SelectOptions(self.max_new_tokens, t, k, self.do_sample, b,
                             self.stop_id, self.num_samples, self.seed, dict(self.extra))
