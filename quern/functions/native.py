"""The comparison of two blocks of texts as a function of the JVM, compiled by the compiler that Spark itself runs on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession

#: LETTERS - 1 characters are counted by themselves, each up to LEVELS, of which 64 * WORDS are features; every LOOK
#: characters it is seen whether a pair can still reach its least length.
_SOURCE = r"""
package quern;

public class SimilarTexts implements org.apache.spark.sql.api.java.UDF6 {
    static final int LETTERS = 256, LEVELS = 64, WORDS = 4, LOOK = 8;

    static int[][] points(scala.collection.Seq texts) {
        int[][] out = new int[texts.length()][];
        scala.collection.Iterator it = texts.iterator();
        for (int i = 0; i < out.length; i++) {
            String s = (String) it.next();
            int[] p = new int[s.codePointCount(0, s.length())];
            for (int k = 0, at = 0; k < p.length; k++) { p[k] = s.codePointAt(at); at += Character.charCount(p[k]); }
            out[i] = p;
        }
        return out;
    }

    static int longest(int[][] texts) {
        int out = 0;
        for (int i = 0; i < texts.length; i++) out = Math.max(out, texts[i].length);
        return out;
    }

    static void tell(int[][] texts, int[] number, int[][] has) {
        int[] count = new int[LETTERS];
        for (int i = 0; i < texts.length; i++) {
            java.util.Arrays.fill(count, 0);
            for (int k = 0; k < texts[i].length; k++) count[Math.min(number[texts[i][k]], LETTERS - 1)]++;
            for (int c = 0; c < LETTERS; c++) if (count[c] > 0) has[c][Math.min(count[c], LEVELS)]++;
        }
    }

    /** Bits of the features that each text has; those that it has besides are its rest. */
    static void mark(int[][] texts, int[] number, int[][] place, long[][] bits, int[] rest) {
        int[] count = new int[LETTERS];
        for (int i = 0; i < texts.length; i++) {
            java.util.Arrays.fill(count, 0);
            rest[i] = texts[i].length;
            for (int k = 0; k < texts[i].length; k++) {
                int c = Math.min(number[texts[i][k]], LETTERS - 1);
                if (++count[c] <= LEVELS) {
                    int p = place[c][count[c]] - 1;
                    if (p >= 0) { bits[p >> 6][i] |= 1L << (p & 63); rest[i]--; }
                }
            }
        }
    }

    static int zeros(long[] v, int inside) {
        int out = 0, w = 0;
        for (; inside >= 64; inside -= 64) out += Long.bitCount(~v[w++]);
        return inside > 0 ? out + Long.bitCount(~v[w] & ((1L << inside) - 1)) : out;
    }

    static int zeros(long v, int inside) { return Long.bitCount(inside >= 64 ? ~v : ~v & ((1L << inside) - 1)); }

    static int one(long[] bits, int[] row, int[] y, int n, int least) {
        long v = -1L;
        int m = y.length;
        for (int at = 0; at < m; at++) {
            long u = v & bits[row[y[at]]];
            v = (v + u) | (v - u);
            if ((at & LOOK - 1) == LOOK - 1 && at + 1 - zeros(v, Math.min(at + 1 + n - least, n)) > m - least) return -1;
        }
        return zeros(v, n);
    }

    static int two(long[] bits, int[] row, int[] y, int n, int least) {
        long a = -1L, b = -1L;
        int m = y.length;
        for (int at = 0; at < m; at++) {
            int r = row[y[at]] << 1;
            long u = a & bits[r], t = b & bits[r + 1], sum = a + u;
            long carry = sum + Long.MIN_VALUE < a + Long.MIN_VALUE ? 1L : 0L;
            a = sum | (a - u);
            b = (b + t + carry) | (b - t);
            if ((at & LOOK - 1) == LOOK - 1) {
                int inside = Math.min(at + 1 + n - least, n);
                if (at + 1 - (inside > 64 ? Long.bitCount(~a) + zeros(b, inside - 64) : zeros(a, inside)) > m - least) return -1;
            }
        }
        return Long.bitCount(~a) + zeros(b, n - 64);
    }

    static int many(long[] bits, int[] row, int[] y, int n, int least, long[] v) {
        int words = v.length, m = y.length;
        java.util.Arrays.fill(v, -1L);
        for (int at = 0; at < m; at++) {
            int r = row[y[at]] * words;
            long carry = 0;
            for (int w = 0; w < words; w++) {
                long x = v[w], u = x & bits[r + w], sum = x + u;
                boolean over = sum + Long.MIN_VALUE < x + Long.MIN_VALUE;
                sum += carry;
                carry = over || (carry == 1L && sum == 0L) ? 1L : 0L;
                v[w] = sum | (x - u);
            }
            if ((at & LOOK - 1) == LOOK - 1 && at + 1 - zeros(v, Math.min(at + 1 + n - least, n)) > m - least) return -1;
        }
        return zeros(v, n);
    }

    static long[] ids(scala.collection.Seq from) {
        long[] out = new long[from.length()];
        scala.collection.Iterator it = from.iterator();
        for (int i = 0; i < out.length; i++) out[i] = ((Long) it.next()).longValue();
        return out;
    }

    /** (lesser id, greater id, ratio) of each pair of different texts of x and y as similar as the threshold.  Where the
        offset is 0 or more, x is the part of y from there on, and a text meets only those behind it.

        A text of n times the same character has the features (character, 1) to (character, n), and two texts have at
        least as many features in common as their common subsequence is long.  Those that tell most are bits; of all
        others a text has its rest, and two texts at most the lesser of theirs in common.  A common subsequence of c
        leaves out n - c and m - c characters, so that the first k of y meet the first k + n - c of x, and at most m - c
        of them may be without a partner there. */
    public Object call(Object left, Object right, Object threshold, Object offset, Object leftIds, Object rightIds) {
        long[] xi = ids((scala.collection.Seq) leftIds), yi = ids((scala.collection.Seq) rightIds);
        int[][] x = points((scala.collection.Seq) left), y = points((scala.collection.Seq) right);
        double t = ((Double) threshold).doubleValue();
        int own = ((Integer) offset).intValue(), nx = x.length, ny = y.length;
        // characters by frequency
        int[] number = new int[0x110000];
        int kinds = 0;
        for (int side = 0; side < 2; side++) {
            int[][] texts = side == 0 ? x : y;
            for (int i = 0; i < texts.length; i++) for (int k = 0; k < texts[i].length; k++) if (number[texts[i][k]]++ == 0) kinds++;
        }
        long[] order = new long[kinds];
        for (int p = 0, k = 0; k < kinds; p++) if (number[p] > 0) order[k++] = ((long) -number[p] << 32) + p;
        java.util.Arrays.sort(order);
        for (int k = 0; k < kinds; k++) number[(int) (order[k] & 0xffffffffL)] = k;
        // the features that tell most
        int[][] has = new int[LETTERS][LEVELS + 2], place = new int[LETTERS][LEVELS + 1];
        tell(x, number, has);
        tell(y, number, has);
        long[] told = new long[LETTERS * LEVELS];
        for (int c = 0; c < LETTERS; c++)
            for (int l = LEVELS; l > 0; l--) {
                has[c][l] += has[c][l + 1];
                double share = has[c][l] / (double) (nx + ny);
                told[c * LEVELS + l - 1] = ((long) (-1e9 * share * (1 - share)) << 20) + c * LEVELS + l - 1;
            }
        java.util.Arrays.sort(told);
        for (int k = 0; k < 64 * WORDS; k++) {
            int p = (int) (told[k] & 0xfffffL);
            place[p / LEVELS][p % LEVELS + 1] = k + 1;
        }
        long[][] fx = new long[WORDS][nx], fy = new long[WORDS][ny];
        int[] rx = new int[nx], ry = new int[ny];
        mark(x, number, place, fx, rx);
        mark(y, number, place, fy, ry);
        for (int side = 0; side < 2; side++) {
            int[][] texts = side == 0 ? x : y;
            for (int i = 0; i < texts.length; i++) for (int k = 0; k < texts[i].length; k++) texts[i][k] = number[texts[i][k]];
        }
        int[] need = new int[longest(x) + longest(y) + 1], size = new int[ny], row = new int[kinds];
        for (int k = 0; k < need.length; k++) need[k] = (int) Math.ceil(t * k / 2 - 1e-9);
        for (int j = 0; j < ny; j++) size[j] = y[j].length;
        java.util.ArrayList out = new java.util.ArrayList();
        long[] bits = new long[0];
        int[] near = new int[ny];
        for (int i = 0; i < nx; i++) {
            int n = x[i].length;
            int close = close(own < 0 ? 0 : own + i + 1, fx[0][i], fx[1][i], fx[2][i], fx[3][i], fy[0], fy[1], fy[2], fy[3], rx[i], ry, n, size, need, near);
            if (close == 0) continue;
            int words = (n + 63) / 64, seen = 0;
            for (int k = 0; k < n; k++) if (row[x[i][k]] == 0) row[x[i][k]] = ++seen;
            if (bits.length < (seen + 1) * words) bits = new long[(seen + 1) * words * 2];
            else java.util.Arrays.fill(bits, 0, (seen + 1) * words, 0L);
            for (int k = 0; k < n; k++) bits[row[x[i][k]] * words + (k >> 6)] |= 1L << (k & 63);
            long[] v = new long[words];
            for (int k = 0; k < close; k++) {
                int j = near[k], total = n + size[j], least = need[total];
                int c = words == 1 ? one(bits, row, y[j], n, least) : words == 2 ? two(bits, row, y[j], n, least) : many(bits, row, y[j], n, least, v);
                if (c < least || 2.0 * c / total < t) continue;
                if (n == size[j] && c == n) continue;
                out.add(org.apache.spark.sql.RowFactory.create(new Object[] {Long.valueOf(Math.min(xi[i], yi[j])), Long.valueOf(Math.max(xi[i], yi[j])), Double.valueOf(2.0 * c / total)}));
            }
            for (int k = 0; k < n; k++) row[x[i][k]] = 0;
        }
        return out.toArray();
    }

    static int close(int from, long a, long b, long c, long d, long[] fa, long[] fb, long[] fc, long[] fd, int rest, int[] ry, int n, int[] size, int[] need, int[] near) {
        int out = 0;
        for (int j = from; j < size.length; j++) {
            int common = Long.bitCount(a & fa[j]) + Long.bitCount(b & fb[j]) + Long.bitCount(c & fc[j]) + Long.bitCount(d & fd[j]) + Math.min(rest, ry[j]);
            int m = size[j], least = need[n + m];
            if (common >= least && n >= least && m >= least) near[out++] = j;
        }
        return out;
    }
}
"""
NAME = "quern_similar_texts"


def _array(context: SparkContext, kind: object, *values: object) -> object:
    """An array of the JVM."""
    out = context._gateway.new_array(kind, len(values))
    for k, v in enumerate(values):
        out[k] = v
    return out


def register(spark: SparkSession) -> str:
    """The name under which the session has the function of texts x, texts y, threshold, offset, ids x, ids y to
    array<struct<i, j, ratio>>.  Its classes go to the executors as a jar, once an application."""
    context, jvm = spark.sparkContext, spark._jvm
    if not hasattr(context, "_quern_similar"):
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(_SOURCE)
        jar = Path(tempfile.mkdtemp(prefix="quern-code-")) / "quern-similar.jar"  # the driver's own file; Spark serves it
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in dict(compiler.getBytecodes()).items():
                z.writestr(name.replace(".", "/") + ".class", bytes(code))
        context._jsc.addJar(str(jar))
        load, none = compiler.getClassLoader().loadClass, _array(context, jvm.java.lang.Class)
        context._quern_similar = load("quern.SimilarTexts").getDeclaredConstructor(none).newInstance(_array(context, jvm.java.lang.Object))
        # named by its types: by its arguments alone the gateway may take the one for Scala's functions
        kinds = _array(context, jvm.java.lang.Class, load("org.apache.spark.sql.api.java.UDF6"), load("org.apache.spark.sql.types.DataType"))
        context._quern_udf = load("org.apache.spark.sql.functions").getMethod("udf", kinds)
    kind = jvm.org.apache.spark.sql.types.DataType.fromDDL("array<struct<i:bigint,j:bigint,ratio:double>>")
    made = context._quern_udf.invoke(None, _array(context, jvm.java.lang.Object, context._quern_similar, kind))
    spark._jsparkSession.udf().register(NAME, made.asNondeterministic())  # dear: the optimizer must not repeat it
    return NAME
