"""Plain-Python statements of the layout rules, used as brute-force checks."""

IGNORE = -100


def cps(text):
    return [ord(c) for c in text]


def pair_rows(prompt, response, S, T, bos, eos, pad, mask_pad=False):
    a = cps(prompt)[:S - 1]
    b = cps(response)[:T - 2]
    core = a + [eos, 0 if bos is None else bos] + b + [eos]
    ids = core + [pad] * (S + T - len(core))
    labels = [IGNORE] * (len(a) + 1) + ids[len(a) + 1:]
    if mask_pad:
        labels = [IGNORE if i >= len(core) else v for i, v in enumerate(labels)]
    return ids, labels


def chat_rows(turns, L, eos, human_roles=("human",)):
    """turns: list of (role, value) in order."""
    ids, labels = [], []
    for role, value in turns:
        human = role.lower() in human_roles
        text = "Human: \n" + value + "\n\nAssistant: \n" if human else value
        t = cps(text)
        ids.extend(t + ([] if human else [eos]))
        labels.extend([IGNORE] * len(t) if human else t + [eos])
    ids, labels = ids[:L - 1], labels[:L - 1]
    if all(v <= IGNORE for v in labels):
        labels = [ids[i] if 18 <= i < 24 else v for i, v in enumerate(labels)]
    return ids, [1] * len(ids), labels
