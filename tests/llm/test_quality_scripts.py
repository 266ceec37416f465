"""Fertility bands: plain prose of a script passes, random letters of the same script do not."""

import random

import numpy as np
import pytest

from ledgerloom.llm import quality, vocab

# Articles 1 to 4 of the Universal Declaration of Human Rights, in part.
PROSE = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совесть"
          "ю и должны поступать в отношении друг друга в духе братства. Каждый человек должен обладать всеми пр"
          "авами и всеми свободами, провозглашенными настоящей Декларацией, без какого бы то ни было различия. "
          "Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность. Никто не должен соде"
          "ржаться в рабстве или в подневольном состоянии.",
    "uk": "Всі люди народжуються вільними і рівними у своїй гідності та правах. Вони наділені розумом і совістю"
          " і повинні діяти у відношенні один до одного в дусі братерства. Кожна людина має право на життя, на "
          "свободу і на особисту недоторканність. Ніхто не повинен бути в рабстві або у підневільному стані.",
    "bg": "Всички хора се раждат свободни и равни по достойнство и права. Те са надарени с разум и съвест и сле"
          "два да се отнасят помежду си в дух на братство. Всеки има право на живот, свобода и лична сигурност."
          " Никой не трябва да бъде държан в робство.",
    "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμέν"
          "οι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης. Κάθε "
          "άτομο έχει δικαίωμα στη ζωή, την ελευθερία και την προσωπική του ασφάλεια. Κανείς δεν επιτρέπεται να"
          " ζει υπό καθεστώς δουλείας.",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا "
          "بروح الإخاء. لكل إنسان حق التمتع بكافة الحقوق والحريات الواردة في هذا الإعلان، دون أي تمييز. لكل فرد"
          " الحق في الحياة والحرية وسلامة شخصه. لا يجوز استرقاق أو استعباد أي شخص.",
    "fa": "تمام افراد بشر آزاد به دنیا می‌آیند و از لحاظ حیثیت و حقوق با هم برابرند. همه دارای عقل و وجدان هستن"
          "د و باید نسبت به یکدیگر با روح برادری رفتار کنند. هر کس حق زندگی، آزادی و امنیت شخصی دارد.",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다. 모든 사람은 생명과 신"
          "체의 자유와 안전에 대한 권리를 가진다. 어느 누구도 노예상태 또는 예속상태에 놓여지지 아니한다.",
    "he": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנ"
          "הוג איש ברעהו ברוח של אחוה. כל אדם יש לו הזכות לחיים, לחירות ולבטחון אישי. לא יהיה אדם עבד או משועבד"
          ".",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्ध"
          "ि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए। प्रत्येक व्य"
          "क्ति को जीवन, स्वाधीनता और वैयक्तिक सुरक्षा का अधिकार है।",
    "th": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติ"
          "ต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ บุคคลมีสิทธิในการดำเนินชีวิต ในเสรีธรรม และในความมั่นคงแห่งร่างกาย",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。人人有资格享有本宣言所载的一切权利和自由，不分种族、肤色、性别、语言、宗教、政治或其他见解。人人有权享有生命、自由"
          "和人身安全。",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。すべて人は、生命、自由及び身体"
          "の安全に対する権利を有する。",
    "hy": "Բոլոր մարդիկ ծնվում են ազատ ու հավասար իրենց արժանապատվությամբ ու իրավունքներով։ Նրանք ունեն բանական"
          "ություն ու խիղճ և միմյանց պետք է եղբայրաբար վերաբերվեն։",
    "vi": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều đư"
          "ợc tạo hoá ban cho lý trí và lương tâm và cần phải đối xử với nhau trong tình anh em.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni roz"
          "umem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birb"
          "irlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järk"
          "i ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
}
SCRIPT = {"ru": "cyrillic", "uk": "cyrillic", "bg": "cyrillic", "el": "greek", "ar": "arabic", "fa": "arabic", "ko": "hangul",
          "he": "hebrew", "hi": "devanagari", "th": "thai", "zh": "han", "ja": "kana", "hy": "armenian"}


@pytest.fixture(scope="module")
def words():
    return quality._Words(vocab.byte_bpe(open(vocab.BYTE_BPE, "rb").read()), vocab.piece_bpe(open(vocab.PIECE_BPE, "rb").read()))


def judged(text, words):
    names = [f.split()[0] for f in quality.SCHEMA.split(", ")]
    m = dict(zip(names, quality.measure_texts([text], words)[0]))
    bands = quality.BANDS[m["script"]]
    return m["script"], all(low <= m[k] <= high for k, (low, high) in bands.items())


@pytest.mark.parametrize("lang", sorted(PROSE))
def test_prose_and_random_letters_of_a_script(lang, words):
    text, script = PROSE[lang], SCRIPT.get(lang, "latin")
    assert judged(text, words) == (script, True)
    rng = random.Random(7)
    pool = sorted({c for c in text.lower() if c.isalpha()})
    for _ in range(3):
        junk = " ".join("".join(rng.choice(pool) for _ in range(6)) for _ in range(80))
        assert judged(junk, words)[1] is False


@pytest.mark.parametrize("points", [range(0xE000, 0xE400), range(0x1F300, 0x1F5F0)])
def test_private_code_points_and_pictures(points, words):
    rng = random.Random(8)
    assert judged(" ".join("".join(chr(rng.choice(points)) for _ in range(6)) for _ in range(80)), words)[1] is False


def plain_repeats(numbers):
    windows = {}
    for i in range(len(numbers) - 2):
        windows.setdefault(tuple(numbers[i:i + 3]), []).append(i)
    return len({j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)})


def test_repeats_among_more_words_than_a_key_packs():
    rng = np.random.default_rng(1)
    for high in (4, 1 << 30):  # small numbers and ones beyond 21 bits
        for _ in range(50):
            numbers = rng.integers(0, 4, 60) * (high // 4) + 1
            assert quality.repeated_words(numbers) == plain_repeats(numbers.tolist())
    many = 5_000_000
    assert quality.repeated_words(np.arange(many)) == 0
    again = np.concatenate([np.arange(many), [100, 101, 102, 103], np.arange(many, many + 10), [100, 101, 102, 103]])
    assert quality.repeated_words(again) == 12
