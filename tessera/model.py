"""Schemas of the chat corpus and its manifest, and the fixed values that
must equal the original generator's for byte-exact output.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

# One chat entry = one JSON line {"messages": [{"role", "content"}, ...]}.
CHAT_ENTRY = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])

# Hive-layout partition columns are read as STRING (numeric-looking values
# would otherwise be inferred as INT).
GROUP_COLUMNS = ("skill", "subtopic")

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("skill", T.StringType()),
    T.StructField("subtopic", T.StringType()),
    T.StructField("entries", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("approx_tokens", T.LongType()),
])

# Definition record of one (skill, subtopic): the per-file content source.
DEFINITION = T.StructType([
    T.StructField("skill", T.StringType()),
    T.StructField("subtopic", T.StringType()),
    T.StructField("def", T.StringType()),
    T.StructField("principles", T.ArrayType(T.StringType())),
    T.StructField("examples", T.ArrayType(T.StringType())),
    T.StructField("mistakes", T.ArrayType(T.StringType())),
])

FILE_SUFFIX = ".jsonl"
GROUP_SEPARATOR = "__"
MANIFEST_NAME = "index.jsonl"
CHARS_PER_TOKEN = 4
UNKNOWN_RANK = 99

# Rotated picks: (array field, stride) -> element (idx div stride) % size.
ROTATION_STRIDES = {"examples": 1, "principles": 3, "mistakes": 5}

# Generation budget of the original corpus: target entries per file and the
# attempt budget (a multiple of the target).
TARGET_PER_FILE = 12000
ATTEMPTS_PER_TARGET = 5

# --------------------------------------------------------------------------
# FIXED VALUES. These must equal the original generator's values for the
# output to be byte-identical; they are data, stated here in their original
# order. Placeholders in braces are filled per entry.
# --------------------------------------------------------------------------

SKILL_ORDER = ["thinking", "reasoning", "speaking", "understanding", "coding"]

AUDIENCES = [
    "a beginner who has never seen the concept before",
    "an intermediate practitioner looking to deepen understanding",
    "an advanced expert who wants a rigorous treatment",
    "a student preparing for an exam",
    "a professional applying the concept at work",
    "a teacher preparing a lesson plan",
    "a self-learner studying independently",
    "a manager who needs a high-level overview",
    "a researcher investigating the underlying theory",
    "a reviewer evaluating the quality of the reasoning",
]

PERSPECTIVES = [
    "from a theoretical foundations angle",
    "from a practical application angle",
    "from a historical development angle",
    "from a comparative perspective (contrasting alternatives)",
    "from a critical/limitation-focused perspective",
    "from a teach-the-skill angle",
    "from an everyday-life angle",
    "from a professional/workplace angle",
    "from a debugging/error-correction angle",
    "from an optimization/mastery angle",
]

FORMATS = [
    "step-by-step procedure",
    "bulleted checklist",
    "worked example with concrete numbers",
    "scenario walkthrough",
    "Q&A dialogue",
    "compare-and-contrast table description",
    "decision tree narrative",
    "common mistakes and corrections",
    "before/after transformation",
    "principles-then-application",
]

PROMPT_TEMPLATES = [
    "Explain {topic} {perspective} for {audience}. Provide a {fmt}.",
    "What is {topic}? Walk through it as a {fmt} {perspective}, aimed at {audience}.",
    "Teach me {topic} using a {fmt}. I am {audience}. Approach it {perspective}.",
    "Give a concrete real-world example illustrating {topic}, formatted as a {fmt}, {perspective}, for {audience}.",
    "What are the most common mistakes people make with {topic}, and how to fix each? {perspective}. For {audience}.",
    "How would you assess whether someone has truly mastered {topic}? Provide a {fmt} {perspective}, for {audience}.",
    "Connect {topic} to a real decision someone might face at work. Use a {fmt} {perspective}. For {audience}.",
    "Trace the historical evolution of {topic}. {perspective}. Format as a {fmt}. For {audience}.",
    "Contrast {topic} with its closest alternative. When does each apply? {fmt} {perspective}. For {audience}.",
    "Design a 30-minute exercise to teach {topic}. {perspective}. For {audience}.",
    "What does {topic} look like when done well vs poorly? {fmt} {perspective}. For {audience}.",
    "Build a checklist for applying {topic} in a real project. {perspective}. For {audience}.",
    "Explain the failure modes of {topic}. What goes wrong, and how to prevent it? {fmt} {perspective}. For {audience}.",
    "How does {topic} interact with constraints (time, budget, stakeholders)? {fmt} {perspective}. For {audience}.",
    "What would a 1-page reference card for {topic} contain? {perspective}. For {audience}.",
]

# The assistant answer. {title} is the humanised subtopic, {Title} the same
# with sentence capitalisation, {definition} the record's "def".
ANSWER_TEMPLATE = """\
Here is a treatment of **{title}** {perspective}, formatted as a {fmt}, written for {audience}.

**Definition.** {Title} is {definition}. The discipline matters because the underlying skill is what separates decisions that hold up under pressure from those that collapse when conditions shift; without it, practitioners default to pattern-matching from prior cases, which works until the current case is structurally different from those prior cases.

**Why it matters.** In professional practice, the cost of {title} done poorly is rarely paid by the person doing it — it is paid by the receiver, the operator, the next maintainer, or the customer. A poorly-framed problem produces the wrong solution. A poorly-evaluated claim produces a wrong decision. A poorly-communicated finding produces a wrong response. The skill is therefore not a personal preference but a professional obligation.

**Core principles.** The practitioner operates from a small set of durable principles, of which the most relevant here is: *{principle}*. This principle is not a slogan; it is a discipline that must be applied at the right moment. Apply it too early and you stall; apply it too late and the cost has already compounded.

**Worked example.** Consider: {example} The example illustrates how the abstract principle becomes a concrete decision. The decision-maker must (1) recognize the situation as one in which the principle applies, (2) resist the temptation to act on the first plausible framing, and (3) execute the discipline even when under time pressure or social pressure to skip it.

**Common mistake to avoid.** A frequent failure mode is: *{mistake}*. This mistake is seductive because it feels productive in the moment — the practitioner is doing *something*, just not the right thing. The correction is usually structural: change the process so the mistake is harder to make, rather than relying on willpower to avoid it.

**Application checklist.**
1. Identify the situation type — does {title} apply here?
2. State the principle you will apply and why.
3. Articulate at least one alternative framing or approach.
4. Identify what would falsify your chosen approach.
5. Execute, then review the outcome against the prediction.
6. Update your mental model based on the gap.

**Mastery indicators.** A practitioner has mastered {title} when they can: name three alternatives to any position they hold; distinguish what they know from what they assume; update their belief when refuting evidence appears, without resistance; teach the skill to a novice in concrete terms; and recognize the failure modes in their own past work without defensiveness. Mastery is not the absence of mistakes; it is the disciplined reduction of repeat mistakes.

This compact treatment is a starting point; depth comes from deliberate practice on real cases, honest review of outcomes, and iteration on the underlying mental models."""
