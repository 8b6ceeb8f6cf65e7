"""Scores of texts by a gated recurrent language model trained on the corpus.

Words are 64-bit hashes. Counts of all training tokens are gathered by Spark and make the base model,
the vocabulary, the classes and all start weights. A gated recurrent network then predicts the
class of the next word from all words before it in the document; common words have a softmax of
their own in their class, rarer ones share their class by their counts. It is trained by truncated
backpropagation, in parallel on slices of the corpus whose weights are averaged after each round.
Documents run through it in lanes side by side, each from its first word to its end, with the
state carried from window to window.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pergamon.llm.graph import stored
from pergamon.llm.text import text_bytes, word_hashes

#: Words with an output of their own, in classes of equal size, most frequent first.
CLASS_WORDS = 32
WORD_CLASSES = 64
COMMON = CLASS_WORDS * WORD_CLASSES

#: Words whose counts every task holds, at most; the rest is looked up by a join.
HEAD = 1 << 18

#: Classes of the words between, by count: each holds counts from one power of four to the next.
BANDS = 8
TAIL = WORD_CLASSES + BANDS  # the class of all other words, unseen ones included
CLASSES = TAIL + 1

#: Width of the state, steps of a window, lanes in scoring and in training.
WIDTH = 16
WINDOW = 32
SCORING_WINDOW = 128
LANES = 512
TRAINING_LANES = 512

#: Tokens of a piece: longer documents are cut for training, so that they do not hold up the lanes beside them. A
#: piece begins with the word before it and an empty state. Scoring cuts no document.
PIECE = 1024

#: Rounds of averaging, each over another part of the training documents, tokens of a slice in all
#: rounds, and Adam's rate.
ROUNDS = 3
SLICE_TOKENS = 2_400_000
RATE = 4e-3

#: Sets of weights that one task averages.
FOLD = 16

#: Tokens that are scored together, and rows of a softmax that are worked on at a time.
CHUNK_TOKENS = 4_000_000
ROWS = 2048

END = 0x3C5F1E9A7D284B61  # stands for the end of a text
HELD_OUT, FOLDS = 1, 5
_SEED = 20


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves 1 on division by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def tokens(data):
    """Hashes of the words of a text, and its end."""
    return np.append(word_hashes(data.lower()), np.uint64(END))


def _count(batches):
    for batch in batches:
        seen = [tokens(v.as_py()) for v in batch.column(0)]
        words, times = np.unique(np.concatenate(seen), return_counts=True) if seen else ([], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(words, np.uint64).view(np.int64)), pa.array(np.asarray(times, np.int64))], ["h", "c"])


class Vocabulary:
    """Counts of the most frequent words, found by hash; sizes are bounded by HEAD."""

    def __init__(self, words, counts, n, v):
        order = np.lexsort((words, -counts))
        self.words, self.counts = words[order], counts[order]
        self.n, self.v = n, v
        size = 1 << max(4, int(4 * len(words)).bit_length())
        self.mask = np.uint64(size - 1)
        self.table = np.full(size, -1, dtype=np.int32)
        left = np.arange(len(words))
        slot = self.words & self.mask
        while len(left):  # each free slot takes one of the words that want it; the others go on
            free = self.table[slot[left]] < 0
            self.table[slot[left[free]]] = left[free]
            left = left[self.table[slot[left]] != left]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
        smooth = self.counts + 0.5
        common = min(COMMON, len(words))
        self.classes = np.full(len(words) + 1, TAIL, dtype=np.int16)
        self.classes[:common] = np.arange(common) // CLASS_WORDS
        if len(words) > common:
            top = self.counts[common]
            band = np.floor(np.log(top / self.counts[common:]) / np.log(4)).astype(int)
            self.classes[common:-1] = WORD_CLASSES + np.minimum(band, BANDS - 1)
        total = n + 0.5 * (v + 1)
        self.mass = np.bincount(self.classes[:-1], smooth, CLASSES).astype(np.float64)
        self.mass[TAIL] = max(total - smooth.sum(), 0.5)
        self.base = np.append(np.log10(smooth / total), -np.log10(total))
        inside = smooth / self.mass[self.classes[:-1]]
        self.inside = np.append(np.log10(inside), -np.log10(self.mass[TAIL]))
        self.inside[:common] = 0.0  # these come from their own softmax
        self.common = common

    def find(self, hashes):
        """The rank of each word, or len(words) if it isn't held."""
        missing = len(self.words)
        if not missing:
            return np.zeros(len(hashes), dtype=np.int64)
        slot = hashes & self.mask
        found = self.table[slot].astype(np.int64)
        open_ = np.flatnonzero((found >= 0) & (self.words[found] != hashes))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
            found[open_] = self.table[slot[open_]]
            open_ = open_[(found[open_] >= 0) & (self.words[found[open_]] != hashes[open_])]
        return np.where(found < 0, missing, found)

    def inputs(self, ranks):
        """Rows of the input table: common words have their own, others that of their class."""
        return np.where(ranks < self.common, ranks, COMMON + self.classes[ranks]).astype(np.int32)

    def start(self):
        """Weights of a network that knows the counts and nothing else."""
        rng = np.random.default_rng(_SEED)
        bias = np.full(COMMON, -20.0, dtype=np.float32)
        bias[: self.common] = np.log(self.counts[: self.common] + 0.5)
        return {
            "E": rng.normal(0, 0.1, (COMMON + CLASSES, 3 * WIDTH)).astype(np.float32),
            "Ug": rng.normal(0, 0.2, (WIDTH, 2 * WIDTH)).astype(np.float32),
            "Un": rng.normal(0, 0.2, (WIDTH, WIDTH)).astype(np.float32),
            "C": np.zeros((WIDTH, CLASSES), dtype=np.float32),
            "c": np.log(np.maximum(self.mass, 1e-9)).astype(np.float32),
            "W": np.zeros((WORD_CLASSES, WIDTH, CLASS_WORDS), dtype=np.float32),
            "w": bias.reshape(WORD_CLASSES, CLASS_WORDS),
        }


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _tanh(x):
    return 1 - 2 / (1 + np.exp(2 * x))


def _steps(weights, x, keep, h, memory=None):
    """States after each step; x and keep are (steps, lanes)."""
    out = np.empty((len(x), *h.shape), dtype=np.float32)
    for t in range(len(x)):
        a = weights["E"][x[t]]
        before = h * keep[t][:, None]
        gates = _sigmoid(a[:, : 2 * WIDTH] + before @ weights["Ug"])
        r, z = gates[:, :WIDTH], gates[:, WIDTH:]
        seen = r * before
        new = _tanh(a[:, 2 * WIDTH :] + seen @ weights["Un"])
        h = new + z * (before - new)
        out[t] = h
        if memory is not None:
            memory.append((before, gates, seen, new))
    return out


def _by_class(classes):
    """(class, positions) of the common words, grouped."""
    at = np.flatnonzero(classes < WORD_CLASSES)
    at = at[np.argsort(classes[at], kind="stable")]
    cuts = np.searchsorted(classes[at], np.arange(WORD_CLASSES + 1))
    return [(k, at[cuts[k] : cuts[k + 1]]) for k in range(WORD_CLASSES) if cuts[k] < cuts[k + 1]]


def _log_picked(logits, at):
    """Log of the softmax at one place of each row."""
    rows = np.arange(len(logits))
    logits -= logits.max(axis=1, keepdims=True)
    picked = logits[rows, at]
    return picked - np.log(np.exp(logits, out=logits).sum(axis=1))


def _errors(logits, at, share):
    """Softmax less one at one place of each row, times the row's share: the gradient of the logits."""
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    scale = share / p.sum(axis=1)
    p *= scale[:, None]
    p[np.arange(len(p)), at] -= share
    return p


def _log_probabilities(weights, states, ranks, classes):
    """Natural log of the class and, for common words, of the word in it; states is (n, WIDTH)."""
    out = np.empty(len(states), dtype=np.float32)
    for i in range(0, len(states), ROWS):
        out[i : i + ROWS] = _log_picked(states[i : i + ROWS] @ weights["C"] + weights["c"], classes[i : i + ROWS])
    for k, at in _by_class(classes):
        out[at] += _log_picked(states[at] @ weights["W"][k] + weights["w"][k], ranks[at] - k * CLASS_WORDS)
    return out


def _lanes(lengths, lanes):
    """Documents dealt to lanes, the longest first to the shortest lane: (lane, start) and lane lengths.

    The longest document sets the number of steps, so there are no more lanes than keep all their
    places within about twice the tokens.
    """
    lanes = max(1, min(lanes, len(lengths), int(2 * lengths.sum() // lengths.max())))
    heap = np.zeros(lanes, dtype=np.int64)
    lane, start = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i in range(0, len(order), lanes):  # a round gives each lane one document
        docs = order[i : i + lanes]
        free = np.argsort(heap, kind="stable")[: len(docs)]
        lane[docs], start[docs] = free, heap[free]
        heap[free] += lengths[docs]
    rank = np.empty(lanes, dtype=np.int64)
    by_length = np.argsort(-heap, kind="stable")
    rank[by_length] = np.arange(lanes)
    return rank[lane], start, heap[by_length]


def _packed(ranks, lengths, vocabulary, lanes, begins=None):
    """Targets, inputs and state-keeping flags in lanes: arrays (steps, lanes), and each token's place.

    `begins` tells which stretches begin a document; others go on from the word before them.
    """
    lane, start, heights = _lanes(lengths, lanes)
    step = np.arange(len(ranks)) - np.repeat(np.cumsum(lengths) - lengths - start, lengths)
    column = np.repeat(lane, lengths)
    shape = (int(heights[0]), len(heights))
    target = np.full(shape, len(vocabulary.words), dtype=np.int32)
    target[step, column] = ranks
    before = np.empty(len(ranks), dtype=np.int32)
    before[1:] = vocabulary.inputs(ranks[:-1])
    firsts = np.cumsum(lengths) - lengths
    fresh = firsts if begins is None else firsts[begins]
    before[fresh] = vocabulary.inputs(vocabulary.find(np.array([END], dtype=np.uint64)))[0]
    x = np.zeros(shape, dtype=np.int32)
    x[step, column] = before
    keep = np.ones(shape, dtype=bool)
    keep[step[firsts], column[firsts]] = 0
    return target, x, keep, heights, step, column


def log_likelihoods(weights, vocabulary, ranks, lengths):
    """Natural log probability of each document by the network (without shares inside rare classes)."""
    target, x, keep, heights, step, column = _packed(ranks, lengths, vocabulary, LANES)
    scores = np.zeros(target.shape, dtype=np.float32)
    h = np.zeros((target.shape[1], WIDTH), dtype=np.float32)
    with np.errstate(over="ignore"):
        for t in range(0, len(target), SCORING_WINDOW):
            n = int(np.searchsorted(-heights, -t))  # lanes are sorted by length: those that go on are first
            states = _steps(weights, x[t : t + SCORING_WINDOW, :n], keep[t : t + SCORING_WINDOW, :n], h[:n])
            h = states[-1]
            goal = target[t : t + SCORING_WINDOW, :n].ravel()
            found = _log_probabilities(weights, states.reshape(-1, WIDTH), goal, vocabulary.classes[goal])
            scores[t : t + SCORING_WINDOW, :n] = found.reshape(-1, n)
    return np.add.reduceat(scores[step, column].astype(np.float64), np.cumsum(lengths) - lengths)


def _gradients(weights, x, keep, h, target, classes, weight):
    """Mean gradients over a window of (steps, lanes), and the states after it."""
    memory = []
    states = _steps(weights, x, keep, h, memory)
    flat, goal = states.reshape(-1, WIDTH), target.ravel()
    share = (weight.ravel() / max(weight.sum(), 1)).astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    d = np.empty_like(flat)
    for i in range(0, len(flat), ROWS):
        some = flat[i : i + ROWS]
        p = _errors(some @ weights["C"] + weights["c"], classes[i : i + ROWS], share[i : i + ROWS])
        grads["C"] += some.T @ p
        grads["c"] += p.sum(axis=0)
        d[i : i + ROWS] = p @ weights["C"].T
    for k, at in _by_class(classes):
        some = flat[at]
        q = _errors(some @ weights["W"][k] + weights["w"][k], goal[at] - k * CLASS_WORDS, share[at])
        grads["W"][k], grads["w"][k] = some.T @ q, q.sum(axis=0)
        d[at] += q @ weights["W"][k].T
    d = d.reshape(states.shape)
    into = np.empty((*x.shape, 3 * WIDTH), dtype=np.float32)
    later = np.zeros_like(h)
    for t in range(len(x) - 1, -1, -1):
        before, gates, seen, new = memory[t]
        r, z = gates[:, :WIDTH], gates[:, WIDTH:]
        dh = d[t] + later
        dn = dh * (1 - z) * (1 - new * new)
        ds = dn @ weights["Un"].T
        dg = np.concatenate((ds * before, dh * (before - new)), axis=1) * gates * (1 - gates)
        grads["Un"] += seen.T @ dn
        grads["Ug"] += before.T @ dg
        into[t, :, : 2 * WIDTH], into[t, :, 2 * WIDTH :] = dg, dn
        later = (dh * z + ds * r + dg @ weights["Ug"].T) * keep[t][:, None]
    order = np.argsort(x.ravel(), kind="stable")
    rows, first = np.unique(x.ravel()[order], return_index=True)
    grads["E"][rows] = np.add.reduceat(into.reshape(-1, 3 * WIDTH)[order], first, axis=0)
    return grads, states[-1]


def train(weights, vocabulary, documents, rate=RATE):
    """Weights after one pass over some documents (arrays of ranks), by truncated backpropagation."""
    whole = np.array([len(d) for d in documents], dtype=np.int64)
    pieces = -(-whole // PIECE)
    last = np.cumsum(pieces) - 1
    lengths = np.full(int(pieces.sum()), PIECE, dtype=np.int64)
    lengths[last] = whole - (pieces - 1) * PIECE
    begins = np.zeros(len(lengths), dtype=bool)
    begins[last - pieces + 1] = True
    target, x, keep, heights, step, column = _packed(
        np.concatenate(documents), lengths, vocabulary, TRAINING_LANES, begins)
    weight = np.zeros(target.shape, dtype=np.float32)
    weight[step, column] = 1
    weights = {k: v.copy() for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    h = np.zeros((target.shape[1], WIDTH), dtype=np.float32)
    with np.errstate(over="ignore"):
        for i, t in enumerate(range(0, len(target), WINDOW), 1):
            n = int(np.searchsorted(-heights, -t))
            part = (slice(t, t + WINDOW), slice(0, n))
            grads, h = _gradients(weights, x[part], keep[part], h[:n], target[part],
                                  vocabulary.classes[target[part].ravel()], weight[part])
            scale = rate * np.sqrt(1 - 0.999**i) / (1 - 0.9**i)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                weights[k] -= scale * first[k] / (np.sqrt(second[k]) + 1e-8)
    return weights


def _flat(weights):
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def _unflat(flat, like):
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def _weight_batch(n, flat):
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["n", "w"])


def _fold(batches):
    """The mean of some sets of weights, each counted by its tokens, as one set."""
    total, mean = 0, None
    for batch in batches:
        for n, w in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(w.as_py(), dtype=np.float32).astype(np.float64) * n
            mean, total = part if mean is None else mean + part, total + n
    if total:
        yield _weight_batch(total, (mean / total).astype(np.float32))


def _trained(samples, slices, vocabulary):
    """Weights after ROUNDS rounds; in each, every slice trains on another part of its documents.

    A slice is a task. Its weights are written, and averaged FOLD at a time, so the driver gets one set.
    """
    weights = vocabulary.start()
    for turn in range(ROUNDS):
        def work(batches, turn=turn, weights=weights):
            documents = []
            for batch in batches:
                documents += [np.frombuffer(v.as_py(), dtype=np.int32) for v in batch.column(0)]
            if documents:
                done = train(weights, vocabulary, documents, RATE / (1 + turn))
                yield _weight_batch(sum(map(len, documents)), _flat(done))

        part = samples.filter(F.col("turn") == turn).repartitionById(slices, F.col("slice")).select("ranks")
        sets, left = stored(part.mapInArrow(work, "n long, w binary"), "weights"), slices
        while left > 1:
            left = -(-left // FOLD)
            sets = stored(sets.repartition(left).mapInArrow(_fold, "n long, w binary"), "weights")
        mean = sets.first()
        if mean:
            weights = _unflat(np.frombuffer(bytes(mean["w"]), dtype=np.float32), weights)
    return weights


def _head(counts):
    """(n, v, words, counts): totals, and at most HEAD of the most frequent words."""
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(
        F.count("*").alias("words"), F.sum("c").alias("tokens")).collect()
    n, v = sum(r.tokens for r in levels), sum(r.words for r in levels)
    held, least = 0, None
    for r in sorted(levels, key=lambda r: -r.level):
        if held + r.words > HEAD:
            break
        held, least = held + r.words, r.level
    rows = counts.filter(level >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    return n, v, np.array(rows.column("h"), dtype=np.int64).view(np.uint64), np.array(rows.column("c"), dtype=np.int64)


def language_model_scores(docs, doc_id="doc_id", text="text"):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Both scores are log10 probabilities of the whole text and its end. Documents with crc32 of the id
    leaving 1 on division by 5 are held out of all learning. Counts cover every training token, and
    every training document gives gradients in one of the rounds, dealt by the hash of its row's number. Null and empty texts have one token, the end. Repeated rows are repeated and learnt
    from as often; without training tokens all words are equally unseen.

    Words beyond the HEAD most frequent ones, of any number, get their counts by a join, whose hot keys
    Spark can split; tasks hold the head, the weights and a bounded number of tokens.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"),
                       text_bytes(text).alias("text"))
    learnt = rows.filter("not held_out")
    counts = learnt.select("text").mapInArrow(_count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    counts = stored(counts, "word-counts")
    n, v, words, times = _head(counts)
    vocabulary = Vocabulary(words, times, n, v)

    def sample(batches):
        for batch in batches:
            made = [vocabulary.find(tokens(t.as_py())).astype(np.int32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["key", "ranks"])

    slices = max(1, -(-n // SLICE_TOKENS))
    # Rows are dealt by their number, so that equal ids and texts are spread; it is read once, when samples are written.
    samples = stored(learnt.withColumn("key", F.xxhash64(F.monotonically_increasing_id(), F.lit(3))).select("key", "text").mapInArrow(sample, "key long, ranks binary").select(
        "ranks", F.pmod(F.shiftright("key", 8), F.lit(ROUNDS)).alias("turn"),
        F.pmod(F.shiftright("key", 16), F.lit(slices)).cast("int").alias("slice")), "samples")
    weights = _trained(samples, slices, vocabulary)

    def score(batches):
        part, made = TaskContext.get().partitionId() << 40, 0

        def flush(held):
            lengths = np.array([len(t) for _, _, t in held], dtype=np.int64)
            hashes = np.concatenate([t for _, _, t in held])
            ranks = vocabulary.find(hashes)
            firsts = np.cumsum(lengths) - lengths
            rare = ranks == len(vocabulary.words)
            base = np.add.reduceat(vocabulary.base[ranks], firsts)
            own = log_likelihoods(weights, vocabulary, ranks, lengths) / np.log(10)
            own += np.add.reduceat(vocabulary.inside[ranks], firsts)
            n_rare = np.add.reduceat(rare.astype(np.int64), firsts)
            offsets = np.concatenate(([0], np.cumsum(n_rare))).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(made, made + len(held)) + part), pa.array([i for i, _, _ in held], pa.int64()),
                 pa.array([o for _, o, _ in held], pa.bool_()), pa.array(lengths), pa.array(lengths - n_rare),
                 pa.array(base), pa.array(own),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[rare].view(np.int64)))],
                ["row", "doc_id", "held_out", "n_tokens", "n_head", "base", "own", "rare"])

        held, size = [], 0
        for batch in batches:
            for i, o, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.append((i, o, tokens(t.as_py())))
                size += len(held[-1][2])
                if size >= CHUNK_TOKENS:
                    yield flush(held)
                    made += len(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    scored = stored(rows.mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, own double, "
        "rare array<long>"), "scores")
    rare = scored.select("row", F.explode("rare").alias("h")).join(counts, "h", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("rare_log"), F.count("c").alias("n_rare"))
    more = F.coalesce("rare_log", F.lit(0.0))
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("own") + more).alias("score"))
