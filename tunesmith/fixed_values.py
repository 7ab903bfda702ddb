"""Fixed values.

Everything in this module has to equal the values users already work with: token
spellings, prompt wording, default limits, stage settings, category texts.  They
are data, kept together and in their natural order.
"""

from __future__ import annotations

# --- special tokens -------------------------------------------------------
PAD = "<|pad|>"
START = "<|im_start|>"
END = "<|im_end|>"
VISION_START = "<|vision_start|>"
VISION_END = "<|vision_end|>"
IMAGE_PAD = "<|image_pad|>"
VIDEO_PAD = "<|video_pad|>"
SPECIALS = (PAD, START, END, VISION_START, VISION_END, IMAGE_PAD, VIDEO_PAD)

# ids of this engine's own vocabulary: pad, start, end, unknown, then words
PAD_ID = 0
START_ID = 1
END_ID = 2
UNKNOWN_ID = 3
FIRST_WORD_ID = 4

IGNORE_LABEL = -100

# --- chat rendering -------------------------------------------------------
DEFAULT_SYSTEM = "You are a helpful assistant."

# --- revision prompt, in the order instruction / reply / criterion ---------
REVISION_PIECES = (
    "Below is an instruction and my initial response. A criteria for evaluating the response is also provided.\n\nInstruction:\n",
    "\n\nMy Initial Response:\n",
    "\n\nCriteria: ",
    "\n\nMy initial response may be incorrect and may not follow the criteria. Please revise it using the ideal response as a guide and the criteria for improvement. Return only the revised answer, without any additional comments or explanation.",
)

# --- token-row lengths ----------------------------------------------------
SFT_LENGTH = 720
PREFERENCE_LENGTH = 1024
REVISION_LENGTH = 512

# --- curriculum: stage, epochs --------------------------------------------
STAGES = (("short", 13), ("med", 8), ("long", 5))
STAGE_MAX_SAMPLES = 2000

# --- corpus splits (half-open; None = to the end) ---------------------------
SFT_BOUNDS = {"train": (300_000, 455_000), "val": (455_000, None)}
PREFERENCE_BOUNDS = {"train": (0, 60_000), "val": (60_000, None)}

# --- batch-inference requests ----------------------------------------------
REQUEST_PROMPT_TOKENS = 600
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
REQUEST_MODEL = "o4-mini-2025-04-16"
REQUEST_MAX_TOKENS = 512
REQUEST_TEMPERATURE = 0.0
REQUEST_FREQUENCY_PENALTY = 1.5
REQUEST_PRESENCE_PENALTY = 0.0

# --- evaluation -------------------------------------------------------------
EVAL_SAMPLES = 100
EVAL_SEED = 42
BETA = 0.5

# --- category -> criterion ---------------------------------------------------
CRITERIA = (
    ("Content Creation & Writing", "A good response is clear, coherent, and well-structured, addressing the key points outlined in the prompt. It should maintain the requested style (e.g., journalistic, instructional, engaging), meet length and formatting expectations, and ensure accurate, relevant content."),
    ("Code & Technical Implementation", "The response should provide clean, executable code that directly addresses the task, with clear comments explaining each step. It should handle any specified edge cases and, where relevant, demonstrate understanding of underlying concepts."),
    ("Translation & Language Conversion", "The response should accurately and succinctly label or classify the input based on context and examples provided, using the correct label or answer format requested."),
    ("Sentiment & Classification Tasks", "The response should accurately and succinctly label or classify the input based on context and examples provided, using the correct label or answer format requested."),
    ("Summarization & Paraphrasing", "Responses should condense the input into concise, coherent text that captures the main ideas while preserving essential details and ensuring logical flow."),
    ("Inference & Reasoning", "Good responses use logical reasoning to justify conclusions, clearly showing how the inference aligns with the provided premise or context."),
    ("Short-Form & Factual Q&A", "The answer should be short, direct, and factual, addressing the core of the question and providing useful, precise information."),
    ("Creative Ideation & Strategy", "Good responses are original, creative, and relevant to the context. They should align with the goals (e.g., improving engagement, enhancing accessibility) and include actionable, well-reasoned ideas."),
)
