"""Chat templates as column expressions.

The template text is not part of the data: the reference takes it from the
tokenizer at run time.  A template here is three strings -- the text
before a message (with a ``{role}`` slot), the text after it, and the
opening of an assistant turn for generation prompts -- plus an optional
system text inserted when a conversation has none.  The default uses ChatML
markers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    message_prefix: str = "<|im_start|>{role}\n"
    message_suffix: str = "<|im_end|>\n"
    generation_prompt: str = "<|im_start|>assistant\n"
    default_system: str | None = None

    def _prefix_parts(self) -> tuple[str, str]:
        if "{role}" not in self.message_prefix:
            raise ValueError("message_prefix needs a {role} slot")
        before, after = self.message_prefix.split("{role}", 1)
        return before, after

    def message_text(self, role: Column, content: Column) -> Column:
        """One rendered message."""
        before, after = self._prefix_parts()
        return F.concat(F.lit(before), role, F.lit(after), content, F.lit(self.message_suffix))

    def with_default_system(self, messages: Column) -> Column:
        if self.default_system is None:
            return messages
        sys_msg = F.array(F.struct(F.lit("system").alias("role"),
                                   F.lit(self.default_system).alias("content")))
        first_is_system = F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system",
                                     F.lit(False))
        return F.when(first_is_system, messages).otherwise(F.concat(sys_msg, messages))

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        """Whole conversation text; with the opened assistant turn if asked."""
        msgs = self.with_default_system(messages)
        body = F.array_join(F.transform(msgs, lambda m: self.message_text(m["role"], m["content"])), "")
        if add_generation_prompt:
            return F.concat(body, F.lit(self.generation_prompt))
        return body


CHATML = ChatTemplate()
