"""Stand-ins for an external model and for a destination: pure functions of their input.

Each is built inside a function, so that it travels to the tasks by value and the workers
need no copy of this package.
"""

from __future__ import annotations

import re


def risk_answers():
    """A number for most records; no answer, an unusable one, or one out of range for others."""

    def scorer(prompts):
        special = {"N/A": None, "0": "not sure", "10": "1.7"}
        found = [re.search(r"nps_score: (\S+)", prompt).group(1) for prompt in prompts]
        return [special[nps] if nps in special else f" 0.{nps}5\n" for nps in found]

    return scorer


def message_answers():
    """A message, or none where there is no NPS answer."""

    def scorer(prompts):
        names = [re.search(r"name: (.*)", prompt).group(1) for prompt in prompts]
        silent = ["nps_score: N/A" in prompt for prompt in prompts]
        texts = [f"Dear {name}, we would like to hear from you.\n" for name in names]
        return [None if quiet else text for quiet, text in zip(silent, texts)]

    return scorer


def sentiment_answers():
    """An analysis as JSON, or text that is none."""

    def scorer(prompts):
        answers = []
        for prompt in prompts:
            nps = re.search(r"nps_score: (\S+)", prompt).group(1)
            mood = "negative" if nps == "N/A" or int(nps) < 7 else "positive"
            answers.append(
                "no idea"
                if nps == "N/A"
                else f'{{"sentiment": "{mood}", "key_insights": ["nps {nps}", "known"], "recommended_action": "call"}}'
            )
        return answers

    return scorer


def destination():
    """Makes clients that name leads after their e-mail, refuse leads without one and refuse
    tasks about satisfaction."""

    def make_client():
        class Client:
            def create(self, kind, fields):
                if kind == "Lead" and "@" not in fields.get("Email", ""):
                    raise ValueError("no e-mail")
                if kind == "Task" and fields["Subject"].startswith("Customer satisfaction"):
                    raise ValueError("not here")
                return f"Lead:{fields['Email'].split('@')[0]}" if kind == "Lead" else f"Task:{fields['WhoId']}"

        return Client()

    return make_client
